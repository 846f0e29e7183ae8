"""Reading and writing files, tables and topics."""

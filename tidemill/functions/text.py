"""Text functions: slugs, query text, redaction, digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that decide what is a variable, a query or a secret.
VARIABLE_PATTERN = r"\$\{([A-Za-z_]\w*)[^}]*\}|\$([A-Za-z_]\w*)"
SQL_PATTERN = r"(?is)^(select|with|show|explain)\b"
SECRET_ENV_PATTERN = r"\b[A-Z][A-Z0-9_]*(?:PASSWORD|PASSWD|SECRET|TOKEN|API_KEY|PRIVATE_KEY)[A-Z0-9_]*\b"
BEARER_PATTERN = r"(?i)(bearer\s+)[A-Za-z0-9._~+/=-]+"
ASSIGNMENT_PATTERN = r"(?i)((?:password|secret|token|api[_-]?key)\s*[:=]\s*)[^\s,;]+"
SECRET_KEY_PATTERN = r"(?i)(?:password|passwd|secret|token|api[_-]?key|private[_-]?key|client[_-]?key)"
SLUG_LENGTH = 80
# a word of each rule above, in any case
SUSPECT_PATTERN = r"(?i)pass(?:word|wd)|secret|token|api[_-]?key|private_key|bearer"


def slug(value: Column, fallback: Column | str = "query") -> Column:
    """Lower case, runs of other characters as one ``-``, trimmed, 80 characters at most."""
    other = F.lit(fallback) if isinstance(fallback, str) else fallback
    dashed = F.regexp_replace(F.lower(value.cast("string")), "[^a-z0-9]+", "-")
    cut = F.substring(F.btrim(dashed, F.lit("-")), 1, SLUG_LENGTH)
    return F.coalesce(F.nullif(cut, F.lit("")), other)


def template_variables(text: Column) -> Column:
    """Sorted distinct names used as ``${name...}`` or ``$name``."""
    uses = F.regexp_extract_all(text, F.lit(VARIABLE_PATTERN), F.lit(0))
    names = F.transform(uses, lambda use: F.regexp_extract(use, r"^\$\{?([A-Za-z_]\w*)", 1))
    return F.array_sort(F.array_distinct(names))


def looks_like_sql(text: Column) -> Column:
    return text.rlike(SQL_PATTERN)


def comment_text(value: Column) -> Column:
    """Text that cannot break out of a one-line SQL comment."""
    flat = F.regexp_replace(value.cast("string"), r"[\r\n]+", " ")
    return F.trim(F.translate(flat, ";", ","))


def sql_document(headers: dict[str, Column], sql: Column) -> Column:
    """One ``-- Name=value;`` line per header, then the statement with its ``;``."""
    body = F.btrim(sql, F.lit(" \t\r\n\f\u000b"))
    closed = F.when(body.endswith(";"), body).otherwise(F.concat(body, F.lit(";")))
    lines = [F.concat(F.lit(f"-- {name}="), comment_text(value), F.lit(";\n")) for name, value in headers.items()]
    return F.concat(*lines, closed, F.lit("\n"))


def redact_text(text: Column) -> Column:
    """Mask secret-named variables, bearer tokens and ``key: value`` secrets, in this order.

    One search for the words that every rule needs spares most texts the three rewrites.
    """
    masked = F.regexp_replace(text, SECRET_ENV_PATTERN, "<redacted-env>")
    masked = F.regexp_replace(masked, BEARER_PATTERN, "$1<redacted>")
    masked = F.regexp_replace(masked, ASSIGNMENT_PATTERN, "$1<redacted>")
    return F.when(text.rlike(SUSPECT_PATTERN), masked).otherwise(text)


def redact_value(key: Column, value: Column) -> Column:
    """``<redacted>`` under a secret-named key, else the text redaction."""
    return F.when(key.rlike(SECRET_KEY_PATTERN), F.lit("<redacted>")).otherwise(redact_text(value))


def sha256_text(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def last_line(text: Column) -> Column:
    """The last line of a trimmed text, empty when there is none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\r\n"))
    return F.substring_index(F.substring_index(trimmed, "\n", -1), "\r", -1)


def bind_variables(text: Column, bindings: dict[str, str]) -> Column:
    """Replace each ``$name`` literally; longer names first, so ``$job`` spares ``$job_id``."""
    for name in sorted(bindings, key=len, reverse=True):
        text = F.replace(text, F.lit(f"${name}"), F.lit(bindings[name]))
    return text


def fill_placeholders(text: Column, bindings: dict[str, str]) -> Column:
    """Replace each ``{{name}}`` literally."""
    for name, value in bindings.items():
        text = F.replace(text, F.lit("{{" + name + "}}"), F.lit(value))
    return text

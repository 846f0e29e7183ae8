"""The entry stands without the training-data package, and hides no other fault."""

import importlib
import sys

import pytest

import __spark_entry__
from tidemill.plans import ORACLES, QUERIES


@pytest.mark.parametrize("absent", ["corpus_pipeline", "tidemill.llm"])
def test_without_the_package(monkeypatch, absent):
    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    monkeypatch.setitem(sys.modules, absent, None)
    bare = importlib.reload(__spark_entry__)
    assert bare.queries().keys() == QUERIES.keys() and bare.oracle_sql() == ORACLES
    monkeypatch.undo()
    importlib.reload(__spark_entry__)


def test_every_oracle_has_a_query():
    assert __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()
    assert QUERIES.keys() <= __spark_entry__.queries().keys()

import sys

import pytest

import __spark_entry__ as registry
from ringcast.plans.queries import QUERIES


@pytest.mark.parametrize("absent", ["ringcast.llm", "ringcast.llm.queries", "corpus_pipeline"])
def test_entry_without_the_optional_parts(monkeypatch, absent):
    class Absent:
        def find_spec(self, name, path=None, target=None):
            if name == absent:
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    for name in list(sys.modules):
        if name.startswith("ringcast.llm") or name == "corpus_pipeline":
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [Absent(), *sys.meta_path])
    found = registry.queries()
    assert set(QUERIES) <= set(found) and "pipeline" not in found
    assert set(registry.oracle_sql()) <= set(found)


def test_errors_of_the_optional_parts_are_not_hidden(monkeypatch):
    class Broken:
        def find_spec(self, name, path=None, target=None):
            if name.startswith("ringcast.llm") or name == "corpus_pipeline":
                raise ModuleNotFoundError("No module named 'numpy'", name="numpy")

    for name in list(sys.modules):
        if name.startswith("ringcast.llm") or name == "corpus_pipeline":
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [Broken(), *sys.meta_path])
    with pytest.raises(ModuleNotFoundError, match="numpy"):
        registry.queries()

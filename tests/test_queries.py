"""Every catalogue query against its SQL on the smallest tables, and the driver contract."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import DATA, ROOT

from vellum.plans import catalog


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """The smallest tables without the few texts whose lines take the SQL engine minutes to compare: for LONG_LINES alone."""
    folder = tmp_path_factory.mktemp("tables")
    for p in Path(DATA).glob("*.parquet"):
        if p.name == "documents.parquet":
            kept = pq.read_table(p, filters=[("n_chars", "<", 20_000)])
            pq.write_table(kept, folder / p.name)
        else:
            (folder / p.name).symlink_to(p)
    return str(folder)


LONG_LINES = {"char_distance_lines"}


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, same_as_sql, tables, name):
    folder = tables if name in LONG_LINES else DATA
    same_as_sql(catalog.QUERIES[name](spark, folder), catalog.ORACLES[name], folder)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_other_queries_give_rows(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


def test_entry_runs(spark):
    import __spark_entry__ as entry

    out = entry.entry(spark)
    assert out.columns == ["lang", "pages", "word_recall", "word_precision", "cer"] and out.count() >= 2


def test_contract_without_the_training_data_subpackage():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("vellum.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
q = e.queries()
assert "pipeline" not in q and not [n for n in q if n.startswith("op")] and len(q) > 40
assert set(e.oracle_sql()) <= set(q)
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)

"""Every registered query against its SQL on the smallest driver tables."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from workload.check import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
CORPUS = re.compile(r"op\d+_|pipeline$")  # these have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not CORPUS.match(n)))
def test_query(spark, con, name):
    ok, text = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF)
    assert ok, text


def test_every_query_has_sql():
    assert {n for n in QUERIES if not CORPUS.match(n)} == {n for n in ORACLE if not CORPUS.match(n)}


def test_results_use_types_both_engines_print_alike(con):
    plain = {"VARCHAR", "BIGINT", "DOUBLE", "BOOLEAN"}
    odd = {
        (name, column, kind) for name, sql in ORACLE.items()
        for column, kind, *_ in con.execute(f"DESCRIBE {sql}").fetchall() if kind not in plain
    }
    assert odd == set()


def test_flagship(spark):
    got = {r.o_orderpriority: (r.index_orders, r.followed, r.days_sum) for r in entry.entry(spark).collect()}
    assert got == {
        "1-URGENT": (82, 5, 75), "2-HIGH": (111, 5, 63), "3-MEDIUM": (101, 9, 160), "4-NOT SPECIFIED": (111, 9, 127),
        "5-LOW": (88, 7, 94),
    }


INVENTORY = {
    "s": range(1, 15), "p": range(1, 25), "u": range(1, 9), "j": range(1, 18), "d": range(1, 9), "f": range(1, 9),
    "r": range(1, 14), "k": range(1, 5), "a": range(1, 11), "x": range(1, 16), "v": range(1, 20),
}


def test_every_operator_of_the_inventory_has_a_query():
    have = {m.group(0) for name in QUERIES if (m := re.match(r"[a-z]\d\d", name))}
    want = {f"{section}{i:02d}" for section, numbers in INVENTORY.items() for i in numbers}
    assert want - have == set()
    assert len([n for n in QUERIES if n.startswith("m_")]) >= 28


def test_nothing_is_committed_that_is_large():
    root = Path(entry.__file__).parent
    assert all(p.stat().st_size < 1_000_000 for p in root.rglob("*.py"))

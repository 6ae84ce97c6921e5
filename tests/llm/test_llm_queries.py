"""All queries: against SQL where there is any, and on hostile and empty tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from llm_tables import DOCUMENTS, SCHEMAS
from tsmedallion.llm.oracle import SQL
from tsmedallion.llm.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
LONG = "the long text goes on and on " * 20_000
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\r\n", "en", "a", 4),
    (4, "one", "en", "a", 3),
    (4, "one", "en", "a", 3),
    (None, "a text that has no id at all", "en", "a", 28),
    (None, None, None, None, None),
    (5, LONG, "en", "a", len(LONG)),
    (6, "12 34 !! ☃", None, "b", 11),
    (7, "Ein Text in deutscher Sprache und noch etwas", "de", None, 44),
    (8, "line\nline\n\nline", "en", "b", 15),
    (9, "\U0001f600 emoji und ümläute 中文", "de", "b", 20),
]
CLASHES = (
    "id fp key comp root head u v m size n rate z copies salt total target score keep lang_pred lang_spans leaks host_key "
    "boilerplate_lines kept_lines dropped mix_size mix_source_size mix_target mix_copies mix_key mix_salt mix_tie mix_n mix_of "
    "mix_place mix_copy id_key hash_key place blob spans path holder todo text_hash page line host view y n_dropped text_md5 "
    "n_words n_base n_bytes n_tokens base accepted fingerprint component_id taken held_out item_id windows edits item term pack seq closes attends tokens position digest kind run radix blocks conv_id turn role path_of"
).split()


def test_all_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in REGISTRY if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in REGISTRY
    assert set(REGISTRY) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    with connect(SF_DIR) as con:
        assert differences(REGISTRY[name](spark, SF_DIR), con, SQL[name]) == []


@pytest.fixture
def odd_tables(spark, write_tables):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(ODD, DOCUMENTS).withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    vectors = [(20, [0.5] * 64, 1), (20, [0.5] * 64, 1), (21, None, None), (22, [None, -1.0], 2), (None, [1.0] * 64, 3), (40, [-0.5] * 64, 0)]
    bench = [(1, None), (None, "x" * 90), (2, ""), (3, "too short"), (4, "the long text goes on and on " * 3)]
    labels = [(5, 1, 0), (7, 0, 1), (None, 1, 0), (4, None, None), (5, 0, 0)]
    turns = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, ""), (None, 3, "assistant", "x"), (2, 0, "assistant", LONG)]
    turns = spark.createDataFrame(turns, SCHEMAS["conversations"])
    turns = turns.withColumns({c: F.lit(f"own {c}") for c in CLASHES if c not in turns.columns})
    return write_tables(documents=docs, embeddings=vectors, benchmark=bench, labels=labels, conversations=turns)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_nulls_repeats_long_texts_and_clashing_names(spark, odd_tables, name):
    rows = REGISTRY[name](spark, odd_tables).collect()
    if name == "op2_hamming_top_k":
        found = [tuple(r) for r in sorted(rows)]
        assert found == [(20, 1, 22, 64), (20, 2, 40, 64), (40, 1, 22, 0), (40, 2, 20, 64)]
    elif name == "op9_decontamination":
        assert {r.doc_id for r in rows} == {5}
    elif name == "op11_lexical_search":
        assert sorted((r.item_id, r.rank, r.doc_id) for r in rows) == [(4, 1, 5), (4, 2, 7), (4, 3, None)]
    elif name == "op12_chat_trees":
        assert {r.conv_id: (r.n_turns, r.loss_chars) for r in rows} == {1: (3, 0), None: (1, 1), 2: (1, len(LONG)), -7: (2, 26)}
    elif name == "pipeline":
        assert {r.doc_id for r in rows} <= {4, 7, 8, 9, None} and all(r.fp == "own fp" for r in rows)
    else:
        assert sorted(r.doc_id or 0 for r in rows) == sorted(i or 0 for i, *_ in ODD)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_empty_tables_give_empty_results(spark, write_tables, name):
    rows = REGISTRY[name](spark, write_tables()).collect()
    assert [r.conv_id for r in rows] == [-7] if name == "op12_chat_trees" else rows == []


def test_rest_imports_without_the_subpackage(tmp_path):
    """The entry module works in a copy of the library without this subpackage."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(contract.__file__))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/tsmedallion", tmp_path / "tsmedallion", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; assert e.queries() and not any(n.startswith('op') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})

"""Registered queries against their SQL, and that the rest stands without them."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from kpiloom.llm.queries import ORACLES, QUERIES
from kpiloom.plans.registry import QUERIES as CORE
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(QUERIES) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    problems, n_spark, n_oracle = compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF)
    assert not problems, problems
    assert n_spark == n_oracle > 0


@pytest.mark.parametrize("name", ["op7_classifier", "op9_quality_rules", "op10_ann", "op1_suffix_tree",
                                  "op11_cross_align", "op12_periodic", "op13_jaccard_join"])
def test_other_queries_return_their_columns(spark, name):
    want = {
        "op1_suffix_tree": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        "op7_classifier": ["doc_id", "held_out", "score", "predicted"],
        "op9_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept"],
        "op11_cross_align": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
        "op12_periodic": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                          "collapsed_sha256"],
        "op13_jaccard_join": ["doc_id", "n_shingles", "component_id"],
        "op10_ann": ["query_id", "rank", "vec_id", "score"],
    }
    df = QUERIES[name](spark, SF)
    assert df.columns == want[name]
    assert df.count() > 0


def test_entry_imports_without_the_subpackage(tmp_path):
    """A copy of the repository without the llm folders and the pipeline."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for name in ("kpiloom", "oracle", "__spark_entry__.py"):
        os.symlink(os.path.join(root, name), tmp_path / name) if name != "kpiloom" else os.makedirs(tmp_path / name)
    for name in os.listdir(os.path.join(root, "kpiloom")):
        if name not in ("llm", "__pycache__"):
            os.symlink(os.path.join(root, "kpiloom", name), tmp_path / "kpiloom" / name)
    os.unlink(tmp_path / "__spark_entry__.py")
    (tmp_path / "__spark_entry__.py").write_text(open(entry.__file__).read())
    own = len(CORE)
    code = f"import __spark_entry__ as e; q = e.queries(); assert len(q) == {own} and len(e.oracle_sql()) == {own}, len(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)


def test_entry_stands_without_a_third_party_module():
    code = ("import sys, warnings; sys.modules['xxhash'] = None; warnings.simplefilter('ignore'); "
            f"import __spark_entry__ as e; assert len(e.queries()) == {len(CORE)}")
    subprocess.run([sys.executable, "-B", "-c", code], cwd=os.path.dirname(os.path.abspath(entry.__file__)), check=True, timeout=120)

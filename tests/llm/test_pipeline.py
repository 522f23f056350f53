import importlib
import inspect
import re

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from kpiloom.llm import bpe, components, mixing, quality_rules, simhash, substring_dedup
from tests.llm import test_quality_rules, test_simhash, test_substring_dedup
from tests.llm.texts import corpus, words


@pytest.fixture
def sf_dir(make, spark, tmp_path):
    """A folder with documents (awkward and plain) and labels."""
    pairs = [(i, t) for i, t in corpus(90)]
    make(pairs, "extra").write.parquet(str(tmp_path / "documents.parquet"))
    test_quality_rules.labels(spark, [(i, 1, 0) for i in range(90)]).write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_stages_have_their_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "simhash near-dedup", "substring dedup", "mixing", "bpe"]


def test_run_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]

    # quality: no cutoff can be shown with so few labels, the base rules decide
    good = []
    for i, t in rows:
        n, _, _, _, repeated = test_quality_rules.brute(t)
        if not (n < 10 or 100 * repeated > 20 * n):
            good.append((i, t))
    # one of each near-copy group: the smallest id
    prints = [test_simhash.fingerprint(t) for _, t in good]
    roots = test_simhash.brute_components(prints)
    best = {}
    for (i, t), r in zip(good, roots):
        key = (i is None, i or 0, t)
        best[r] = min(best.get(r, key), key)
    single = [(None if none else i, t) for none, i, t in best.values()]
    # substrings
    cut = {i: n for i, _, n, _ in test_substring_dedup.brute(single)}
    kept_words = {i: total - gone for i, total, gone, _ in test_substring_dedup.brute(single)}

    frame, out = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, sf_dir)
        out[name] = frame.collect()
        if name != "bpe":
            assert frame.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out["quality rules"]), key=str) == sorted(good, key=str)
    assert sorted((r.doc_id for r in out["simhash near-dedup"]), key=str) == sorted((i for i, _ in single), key=str)
    assert {r.doc_id: len(words(r.text)) for r in out["substring dedup"]} == kept_words
    assert any(cut.values())
    mixed = {}
    for r in out["mixing"]:
        mixed[r.doc_id] = mixed.get(r.doc_id, 0) + len(words(r.text))
    assert all(n <= 2 * kept_words[i] for i, n in mixed.items())
    assert sum(mixed.values()) == pytest.approx(1.5 * sum(kept_words.values()), abs=20)
    library = Tokenizer.from_file(importlib.import_module("public_tokenizers").path("word_bpe_49k.json"))
    want = sorted((r.doc_id if r.doc_id is not None else -1, library.encode(r.text or "", add_special_tokens=False).ids)
                  for r in out["mixing"])
    assert sorted((r.doc_id if r.doc_id is not None else -1, list(r.ids)) for r in out["bpe"]) == want

    whole = corpus_pipeline.run(spark, sf_dir).collect()
    key = lambda r: (str(r.doc_id), r.n_tokens, r.ids_sha256)
    assert sorted(map(key, whole)) == sorted(map(key, out["bpe"]))


def test_empty_documents(spark, make, tmp_path):
    make([]).write.parquet(str(tmp_path / "documents.parquet"))
    test_quality_rules.labels(spark, []).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_take_columns_named_like_their_helpers(spark, make, tmp_path):
    """Every helper name that the operators make, as a further column of the documents."""
    names = set()
    for m in (bpe, components, mixing, quality_rules, simhash, substring_dedup):
        names |= set(re.findall(r'"(_[a-z_]+)"', inspect.getsource(m)))
        names |= set(re.findall(r'alias\("([a-z]+)"\)', inspect.getsource(m)))
    names |= {f"_cut_{r}" for r in quality_rules.GRID} | {"_stratum", "_plan_source", "source_size", "stratum", "fp", "root"}
    names -= {"doc_id", "text", "lang", "source", "n_chars"}
    assert len(names) > 30
    docs = make(corpus(30), " ".join(sorted(names)))
    test_quality_rules.labels(spark, [(i, 1, 0) for i in range(30)]).write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r.root == r.doc_id and r._plan_source == r.doc_id for r in rows), name
    assert stage is corpus_pipeline.mixed
    assert corpus_pipeline.encoded(spark, docs, str(tmp_path)).count() == docs.count()

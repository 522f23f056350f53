import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from kpiloom.llm import common

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
texts = st.lists(st.text(alphabet="ab \t\n\x0b\x1c\xa0éß😀Z", max_size=30) | st.none(), max_size=12)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_of_a_slice(rows):
    data, offsets = common.text_bytes(pa.array(rows, pa.string()))
    starts, ends, first = common.find_words(data, offsets)
    raw = [(t or "").encode() for t in rows]
    want = [WORD.findall(t) for t in raw]
    got = [[data[a:b].tobytes() for a, b in zip(starts[i:j], ends[i:j])] for i, j in zip(first[:-1], first[1:])]
    assert got == want
    joined, at = common.joined_words(data, starts, ends)
    assert [joined[at[i]:max(at[i], at[j] - 1)] for i, j in zip(first[:-1], first[1:])] == [b" ".join(w) for w in want]
    hashes = common.word_hashes(data, starts, ends)
    flat = [w for ws in want for w in ws]
    assert len({(w, int(h)) for w, h in zip(flat, hashes)}) == len(set(flat)) == len(set(hashes.tolist()))
    assert common.lower(data).tobytes() == b"".join(raw).lower()


def test_sliced_and_null_columns():
    column = pa.array(["one", None, "two words", "", "x"]).slice(1, 3)
    data, offsets = common.text_bytes(column)
    assert data.tobytes() == b"two words" and offsets.tolist() == [0, 0, 9, 9]


def test_span_hashes_do_not_depend_on_place():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    values[300:340] = values[20:60]
    a = common.span_hashes(values, np.array([20, 25]), np.array([60, 45]))
    b = common.span_hashes(values, np.array([300, 305]), np.array([340, 325]))
    assert (a == b).all() and a[0] != a[1]


def test_slices_hold_whole_rows():
    rng = random.Random(1)
    rows = ["x" * rng.choice([0, 10, 500, 5000]) for _ in range(200)] + [None]
    batch = pa.RecordBatch.from_pydict({"text": rows})
    parts = list(common.slices(batch, "text", 1000))
    assert [t for p in parts for t in p.column("text").to_pylist()] == rows
    sizes = [[len(t) for t in p.column("text").to_pylist() if t] for p in parts]
    assert all(len(s) <= 1 or sum(s) <= 1000 for s in sizes)
    assert list(common.slices(batch.slice(0, 0), "text")) == []


def test_saved_tables_and_fresh_names(spark):
    df = spark.createDataFrame([(1, "a")], "_x int, b string")
    assert common.fresh(df, "_x", "B", "c") == ["_x_", "B_", "c"]
    saved = common.save(df, "unit")
    assert saved.schema == df.schema and saved.collect() == df.collect()
    assert saved.inputFiles()[0].find(common.shared_dir(spark).removeprefix("file:")) >= 0


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    session = type("S", (), {"conf": Conf(), "sparkContext": Context()})()
    with pytest.raises(ValueError):
        common.shared_dir(session)

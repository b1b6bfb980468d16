import hashlib
import random

import numpy as np
from helpers import documents
from pyspark.sql import functions as F

from visitflow.llm import fim, queries

TEXTS = [
    None, "", "x", "two", "<P>", "a <S> b", "<M", "<<P", "P>", "naïve café über", "日本語 テキスト", "😀😀🎉 ok", "é", "\x00zero\n\t",
    "<P" * 50, "S>M><" * 30, "<" * 40 + ">" * 40, "long é" * 300_000, "a" * 999_999 + "é" * 3 + "<" * 20] + [
    "".join(random.Random(k).choice("ab é€😀<>PSM\n") for _ in range(k % 90)) for k in range(500)]


def brute(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by slices of one text."""
    text = text or ""
    hexed = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_outputs_and_round_trip_like_slices(spark):
    docs = documents(spark, TEXTS + [(None, "no id of its own"), (3, "an id again"), (3, "two")], n=1, form="clash", output="clash").repartition(5)
    made = fim.fill_in_middle(docs)
    rows = fim.restore(made.withColumn("more", F.lit(1))).collect()
    want = [(i, *brute(i, t), t or "") for i, t in enumerate(TEXTS)] + [
        (i, *brute(i, t), t) for i, t in [(None, "no id of its own"), (3, "an id again"), (3, "two")]]
    key = lambda r: (r[0] is not None, r[0] or 0, r[5])
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in rows), key=key) == sorted(want, key=key)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_windows_smaller_than_texts(monkeypatch):
    """Cuts, marks and shifts that cross the windows of a long text."""
    import pyarrow as pa

    for step in (1, 2, 3, 7):
        monkeypatch.setattr(fim, "STEP_BYTES", step)
        ids = [0, 9, 13, 18, 500]
        batch = pa.RecordBatch.from_pydict({"doc_id": ids, "text": [TEXTS[i] if len(TEXTS[i] or "") < 999 else "é<S" * 20 for i in ids]})
        [made] = fim._transformed([batch], "1", 90, 20)
        want = [brute(i, t) for i, t in zip(ids, batch.column(1).to_pylist())]
        assert [tuple(r.values())[1:] for r in made.to_pylist()] == want
        [back] = fim._restored([made], 5)
        assert back.column(6).to_pylist() == [t or "" for t in batch.column(1).to_pylist()]


def test_shifts_are_a_difference_array():
    starts, values = np.array([0, 2, 2, 5]), np.array([3, 9, -2, 4])
    [(at, stop, shift)] = fim.shifts(starts, values, 7)
    assert (at, stop, shift.tolist()) == (0, 7, [3, 3, -2, -2, -2, 4, 4])


def test_outputs_without_their_marks_are_null(spark):
    rows = [("psm", "<P>a<S>b"), ("psm", "<S>a<P>b<M>c"), ("psm", "x<P>a<S>b<M>c"), ("spm", "<S>a<P>b<M>c"), ("psm", ""), ("plain", None), ("psm", "<P><S><M><M>")]
    df = spark.createDataFrame(rows, "form string, output string").coalesce(1)
    assert [r.restored for r in fim.restore(df).collect()] == [None, None, None, "bca", None, "", None]


def test_empty_table_and_query(spark, tmp_path):
    assert fim.fill_in_middle(documents(spark, [])).count() == 0
    docs = documents(spark, TEXTS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op12_fill_in_middle(spark, str(tmp_path)).collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == {
        i: (*brute(i, t)[:4], digest(brute(i, t)[4]), digest(t or "")) for i, t in enumerate(TEXTS)}

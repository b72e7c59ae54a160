"""Hyperdimensional language profiles: the bundles against a plain sum, odd rows, and accuracy on held-out documents."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from catloom.llm import language_id
from catloom.llm.language_id import DIM, UNKNOWN, bundles, language_digest, letters

SCHEMA = "doc_id long, text string, lang string, source string, held_out int, score string, lang_pred long"
DE = "der die und ist nicht ein zu haben werden mit sich auf für von dem den eine als auch nach wie über"
EN = "the of and to in is you that it he was for on are with as his they be at one have this from"


def plain(text):
    """The bundle by one trigram after another."""
    a, b, c = language_id._vectors()
    words = "".join(x if x.isalpha() else " " for x in text.lower()).split()
    out = np.zeros(DIM, np.int64)
    if words:
        s = " " + " ".join(words) + " "
        at = [0 if x == " " else max(1, ord(x) % language_id.PLACES) for x in s]
        for i in range(len(at) - 2):
            out += a[at[i]].astype(int) * b[at[i + 1]] * c[at[i + 2]]
    return out


TEXTS = ["", "a", "1 2 3", "Ein Äpfel-Kuchen, größer!", "  x\ny  ", "日本語 テキスト 中文字", "İstanbul ǅ", "ab" * 500, "one two three " * 40, "\U0001d400 x ퟿ y"]


def test_bundles_are_sums_of_bound_trigrams(monkeypatch):
    want = np.stack([plain(t) for t in TEXTS])
    own = [letters(t) for t in TEXTS]
    assert (bundles(own, list(range(len(own))), len(own)) == want).all()
    assert (bundles(own, [i % 3 for i in range(len(own))], 3) == np.stack([want[i::3].sum(axis=0) for i in range(3)])).all()
    monkeypatch.setattr(language_id, "PIECE", 7)  # long texts in pieces
    assert (bundles(own, list(range(len(own))), len(own)) == want).all()


def table(spark):
    rows = [(i, (EN if i % 2 else DE) + f" {i}", "en" if i % 2 else "de", "s", 1, "x", 2) for i in range(60)]
    rows += [(100, None, "en", None, None, None, None), (101, "", "de", None, None, None, None), (102, "12 34 -- 5", "de", None, None, None, None), (103, DE, None, None, None, None, None)]
    rows += [(None, EN, "xx", None, None, None, None), (7, EN, "en", None, None, None, None), (7, EN, "en", None, None, None, None), (104, EN * 4000, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_odd_rows(spark):
    docs = table(spark)
    got = language_digest(docs.repartition(3)).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    for r in got:
        d = r["doc_id"]
        assert r["held_out"] == (d is not None and zlib.crc32(str(d).encode()) % 4 == 2)
        want = UNKNOWN if d in (100, 101, 102) else "de" if d == 103 or d is not None and d < 60 and d % 2 == 0 else "en"  # a null id is no lesson, so no xx
        assert r["lang_pred"] == want and (want == UNKNOWN) == (r["score"] == 0)
    again = language_digest(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_nothing_to_learn(spark):
    docs = table(spark)
    assert {r["lang_pred"] for r in language_digest(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {UNKNOWN}
    assert language_digest(docs.limit(0)).collect() == []
    one = {r["lang_pred"] for r in language_digest(docs.withColumn("lang", F.lit("en"))).collect()}
    assert one == {"en", UNKNOWN}
    with pytest.raises(ValueError, match="languages"):
        language_digest(docs, max_languages=1)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_digest(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    # neither id, source nor lang of a row is an input of its prediction
    turned = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    assert sorted(map(str, language_digest(turned).collect())) == sorted(map(str, language_digest(docs).collect()))

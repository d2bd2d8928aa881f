"""Very long texts, and a third of all rows without an id or alike: results and the sizes that lead to them."""

import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollgate.llm import jaccard_join, language_id, secrets


@pytest.mark.parametrize("filler", [" ", "\\n", "\n", "\t \\r"])
def test_a_key_header_before_a_million_characters(spark, filler):
    text = "-----BEGIN PRIVATE KEY-----" + filler * (1_000_000 // len(filler))
    docs = spark.createDataFrame([(1, text), (2, text + "A" * 64 + " end")], "doc_id int, text string")
    got = {r.doc_id: [tuple(s) for s in r.findings] for r in secrets.scan(docs, secrets.new_ledger(docs)).collect()}
    assert got[1] == [("pem", 0, 27)] or got[1] == [("pem", 0, len(text))]
    assert got[2][0][:2] == ("pem", 0) and got[2][0][2] >= len(text) + 64


def test_a_key_with_many_headers_and_dashes(spark):
    headers = "".join(f"\nHeader-{i}: value" for i in range(50))
    docs = spark.createDataFrame([
        (1, f"-----BEGIN RSA PRIVATE KEY-----{headers}\n{'QUJD' * 16}\n-----END RSA PRIVATE KEY----- tail"),
        (2, "-----BEGIN PRIVATE KEY-----\n" + "a-b--c" * 60 + "\n-----END PRIVATE KEY----- tail"),
        (3, f"-----BEGIN PRIVATE KEY-----\\n{'QUJD' * 16}\\n{'QUJD' * 16}; then words"),
    ], "doc_id int, text string")
    texts = {r.doc_id: r.text for r in docs.collect()}
    cut = {r.doc_id: texts[r.doc_id][:r.findings[0].start] + texts[r.doc_id][r.findings[0].stop:]
           for r in secrets.scan(docs, secrets.new_ledger(docs)).collect()}
    assert cut[1] == " tail" and cut[2] == " tail" and cut[3].endswith("words") and "QUJD" not in cut[3]


def test_a_hundred_thousand_matches_in_one_text(spark):
    text = "\n".join(f"token={'short' if i % 7 == 0 else 'abcdefgh%d' % i}" for i in range(100_000))
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    start = time.perf_counter()
    [row] = secrets.scan(docs, secrets.new_ledger(docs)).collect()
    assert time.perf_counter() - start < 60
    want = [("assign", m.start(), m.end()) for m in re.finditer(r"token=([a-z0-9]+)", text) if len(m[1]) >= 8]
    assert [tuple(s) for s in row.findings] == want


def test_a_hundred_thousand_secrets_are_cut_out(spark):
    lines = [f"\U0001f600 token={'short' if i % 7 == 0 else 'abcdefgh%d' % i}" + " filler" * (i % 5) for i in range(100_000)]
    hidden = "f" * 40
    text = "\n".join(lines) + f"\nsecret={hidden}" + "x" * 9000 + " end"
    docs = spark.createDataFrame([(1, text), (2, f"key={hidden}"), (3, f"{hidden} {hidden}\n"), (4, "none")], "doc_id int, text string")
    start = time.perf_counter()
    got = {r.doc_id: r.text for r in secrets.redact(docs, secrets.new_ledger(docs)).collect()}
    assert time.perf_counter() - start < 60
    want = re.sub(r"token=(abcdefgh\d+)", "[SECRET]", text)
    want = want[:want.index("secret=")] + "[SECRET] end"
    assert got == {1: want, 2: "key=[SECRET]", 3: "[SECRET] [SECRET]\n", 4: "none"}


def prose(spark, rows, seed):
    """Texts of 40 words from a vocabulary of 3,000, each of its own."""
    word = F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.concat(F.lit("w"), F.pmod(F.xxhash64(F.col("id"), i, F.lit(seed)), F.lit(3000))))
    return spark.range(rows).withColumn("text", F.array_join(word, " "))


def test_join_with_a_third_without_ids(spark, monkeypatch):
    """Each text without an id has one near copy without an id; opened texts stay as many as there are texts."""
    base = prose(spark, 300, 1)
    bare = base.unionAll(base.select("id", F.concat("text", F.lit(" more")))).select(F.lit(None).cast("bigint").alias("doc_id"), "text")
    docs = bare.unionAll(prose(spark, 1200, 2).select(F.col("id").alias("doc_id"), "text")).repartition(4)
    sizes = []

    def measured(df, name, store=jaccard_join.stored):
        out = store(df, name)
        sizes.append((name, out.count())) if name == "opened-sets" else None
        return out

    monkeypatch.setattr(jaccard_join, "stored", measured)
    got = jaccard_join.link_components(docs)
    assert got.count() == 1800 and got.where("doc_id is not null and doc_id <> component_id").count() == 0
    assert sum(n for _, n in sizes) <= 1800
    monkeypatch.undo()
    kept = jaccard_join.one_of_each(docs, jaccard_join.Join(shingle=5, percent=80))
    assert kept.where("doc_id is null").count() == 300 and kept.count() == 1500


def test_language_sample_without_ids_is_bounded(spark, monkeypatch):
    docs = prose(spark, 9000, 3).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 2, F.lit("the same text of this language again")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("id") % 2 == 0, "en").otherwise("fr").alias("lang"))
    sizes = []

    def measured(df, name, store=language_id.stored):
        out = store(df, name)
        sizes.append(out.count()) if name == "language-sample" else None
        return out

    monkeypatch.setattr(language_id, "stored", measured)
    assert language_id.fit(docs, sample=50).languages == ["en", "fr"]
    assert 60 <= sizes[0] <= 250


def test_kept_texts_cross_to_python_once(odd_docs):
    """All columns with the text among them, or the text beside those kept: the same verdicts, and no second copy of the text."""
    model = language_id.fit(odd_docs)
    all_columns = language_id.predict(odd_docs, model, odd_docs.columns)
    assert "_text" not in all_columns._jdf.queryExecution().analyzed().toString()
    some = language_id.predict(odd_docs, model, ["doc_id"])
    facts = ["doc_id", "lang_pred", "score", "rejected"]
    assert sorted(map(str, all_columns.select(facts).collect())) == sorted(map(str, some.select(facts).collect()))


def test_linked_sets_share_a_combination_of_their_prefixes():
    """Random sets around the threshold, small ones too, in any order of all keys: none that link are without a common one, and the keys are few."""
    rnd = np.random.default_rng(5)
    low, high = -(1 << 63), (1 << 63) - 1

    def prefix(keys, tags):
        order = np.lexsort((keys, tags))  # one part a class and deal
        keys, tags = keys[order], tags[order]
        return np.concatenate([keys[tags == t][:np.sum(tags == t) - (t >> 4)] for t in np.unique(tags)])

    for join in (jaccard_join.Join(), jaccard_join.Join(shingle=5, percent=80)):
        sets = []
        for trial in range(3000):
            x = np.unique(rnd.integers(low, high, rnd.integers(1, 12 if trial % 2 else 300), dtype=np.int64))
            kept = rnd.permutation(x)[:max(len(x) - rnd.integers(0, len(x) // 4 + 1), 1)]
            sets += [x, np.unique(np.concatenate((kept, rnd.integers(low, high, rnd.integers(0, 2 + len(x) // 8), dtype=np.int64))))]
        keys, tags, counts = jaccard_join.combination_keys(np.concatenate(sets), np.array([*map(len, sets)]), join)
        ends, linked = np.cumsum(counts)[:-1], 0
        parts = [prefix(k, t) for k, t in zip(np.split(keys, ends), np.split(tags, ends))]
        for i in range(0, len(sets), 2):
            common = len(np.intersect1d(sets[i], sets[i + 1]))
            if 100 * common >= join.percent * (len(sets[i]) + len(sets[i + 1]) - common):
                linked += 1
                assert len(np.intersect1d(parts[i], parts[i + 1]))
        assert linked > 800 and len(keys) < 0.8 * sum(map(len, sets))

"""Quality rules, secret scans, fingerprints and mixing against brute force and on odd tables."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollgate.llm import fingerprint, mixing, quality, secrets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall(text or "")


def repeated_words(found):
    windows = Counter(tuple(found[i:i + 8]) for i in range(len(found) - 7))
    covered = {j for i in range(len(found) - 7) if windows[tuple(found[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(covered)


def base_of(text):
    found, text = words_of(text), text or ""
    lines = [line for line in text.split("\n") if WORD.search(line)]
    repeats = repeated_words(found)
    return (len(found), sum(map(len, found)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), repeats,
            len(found) < 20 or 100 * repeats > 30 * len(found))


FACTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_statistics(documents, texts):
    got = {r.doc_id: tuple(r[c] for c in FACTS) for r in quality.text_statistics(documents).collect()}
    assert got == {i: base_of(r.text) for i, r in texts.items()}


def test_base_statistics_of_odd_rows(odd_docs, odd_rows):
    got = sorted(str((r.doc_id, *[r[c] for c in FACTS])) for r in quality.judge_quality(odd_docs).collect())
    assert got == sorted(str((row[0], *base_of(row[1]))) for row in odd_rows)


def test_quality_verdict_against_numpy(spark, documents):
    """Concentration steps from the same starts, in numpy; labelled good texts stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = quality.judge_quality(docs).toPandas()
    assert not rows.loc[rows.base_failed, "kept"].any()
    used = rows[~rows.base_failed]
    assert used.distance.notna().all()
    # A cell's distances are of its estimate's own rows where every source of the language is large.
    for _, cell in used[~used.cell.str.contains("*", regex=False)].groupby("cell"):
        n, chars = np.maximum(cell.n_words, 1), np.maximum(cell.word_chars, 1)
        x = np.column_stack([np.log(n), np.log(chars / n), np.log1p(100 * cell.n_symbols / chars),
                             np.log1p(100 * cell.n_dup_lines / n), np.log1p(10 * cell.n_repeat_words / n)])
        inside = cell.distance.to_numpy() <= np.quantile(cell.distance, quality.SHARE) + 0.05
        scatter = quality.CONSISTENCY * np.cov(x[inside].T, bias=True) + np.diag(np.square(quality.FLOOR))
        off = x - x[inside].mean(axis=0)
        again = np.einsum("ij,jk,ik->i", off, np.linalg.inv(scatter), off)
        # One more concentration step changes little, and separates the same rows.
        assert np.median(np.abs(again - cell.distance) / (1 + cell.distance)) < 0.15
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    good = rows.merge(labels[labels.quality == 1], on="doc_id")
    assert good[~good.base_failed].kept.mean() > 0.99


def test_small_cells_are_judged_by_wider_estimates(spark):
    """Junk in a small source, a rare language or a lone text is rejected; plain texts of the same cells stay."""
    plain = "the quick brown fox number {0} met {1} dogs near a river bank and told them {2} stories about rain wind sun snow and ice until noon on day {3}"
    junk = " ".join(f"#$%&|<>*#$%&|<>*#$%&|<>*{i}" for i in range(60))
    rows = [("de", "big", plain.format(i, i * 7 % 31, i * 3 % 17, i * 11 % 29)) for i in range(200)]
    rows += [("de", "small", plain.format(i, 1, 2, i * i)) for i in range(5)] + [("de", "small", junk)]
    rows += [("fr", None, plain.format(i, 4, i, 2)) for i in range(3)] + [("fr", None, junk)] + [(None, "x", junk), (None, "x", plain.format(1, 2, 3, 4))]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, lang string, source string, text string")
    got = {r.doc_id: r for r in quality.judge_quality(docs).collect()}
    assert {i: got[i].kept for i in got} == {i: r[2] != junk for i, r in enumerate(rows)}
    assert all(r.distance is not None for r in got.values())
    cells = {rows[i][:2]: r.cell for i, r in got.items()}
    assert cells == {("de", "big"): '{"lang":"de","source":"big"}', ("de", "small"): '{"lang":"de","rest":"*"}',
                     ("fr", None): '{"all":"*"}', (None, "x"): '{"all":"*"}'}
    # The language's estimate rests on all its texts, the widest on all texts; a few texts alone are judged as well.
    few = quality.judge_quality(docs.where("lang = 'fr'")).collect()
    assert len(few) == 4 and all(r.cell == '{"all":"*"}' and r.distance is not None for r in few)
    facts = quality._vectors(quality.text_statistics(docs))
    fed = Counter(c for r in quality._cells(facts, quality.MIN_ROWS).where("not base_failed").collect() for c in r.feeds)
    assert fed == {'{"lang":"de","source":"big"}': 200, '{"lang":"de","rest":"*"}': 206, '{"all":"*"}': 212}


def test_quality_of_no_rows(no_docs):
    assert quality.judge_quality(no_docs).count() == 0


ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def spans_of(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def test_secret_spans(spark, documents, texts, odd_docs, odd_rows):
    for docs, rows in ((documents, [(r.doc_id, r.text) for r in texts.values()]), (odd_docs, [r[:2] for r in odd_rows])):
        got = secrets.scan(docs, secrets.new_ledger(docs)).collect()
        base = sorted(str((r.doc_id, [tuple(s) for s in r.findings if s.kind in secrets.BASE])) for r in got)
        assert base == sorted(str((i, spans_of(t))) for i, t in rows)


def test_failing_match_uses_up_its_characters(spark):
    text = "token=secret:abcdefgh token= password=abcdefgh1 api_key = 'k' APIKEY:\"0123456789\""
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    [row] = secrets.scan(docs, secrets.new_ledger(docs)).collect()
    assert [tuple(s) for s in row.findings] == spans_of(text)


def test_ledger_scans_only_what_it_lacks(spark):
    ledger = secrets.new_ledger(spark.range(1))
    first = spark.createDataFrame([(1, "token = abcdefgh1"), (2, "plain"), (3, "plain")], "doc_id bigint, text string")
    more = spark.createDataFrame([(4, "plain"), (5, "passwd: 12345678x")], "doc_id bigint, text string")
    secrets.scan(first, ledger).count()
    before = spark.read.parquet(ledger).count()
    assert before == 2 * len(secrets.RULES)
    assert [len(r.findings) for r in secrets.scan(more, ledger).orderBy("doc_id").collect()] == [0, 1]
    assert spark.read.parquet(ledger).count() == before + len(secrets.RULES)
    newer = [secrets.Rule(r.kind, r.version + (r.kind == "hex"), r.pattern, r.group, r.least, r.begins) for r in secrets.RULES]
    secrets.scan(first, ledger, newer).count()
    assert spark.read.parquet(ledger).where("rule = 'hex/2'").count() == 2


def test_redaction(odd_docs, odd_rows, no_docs):
    got = secrets.redact(odd_docs, secrets.new_ledger(odd_docs))
    assert got.columns == odd_docs.columns
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[11].text == "[SECRET]\" and [SECRET] \U0001f600" and rows[11].n_chars == len(rows[11].text)
    assert rows[13].text.startswith("key [SECRET]\n[SECRET]\nsame line")
    assert rows[5].text is None and rows[1].text == odd_rows[0][1] and rows[1].blob == 1
    assert got.count() == len(odd_rows) and secrets.redact(no_docs, secrets.new_ledger(no_docs)).count() == 0


def test_redaction_takes_whole_private_keys(spark):
    body = "\n".join("MIIEvQ+/" * 8 for _ in range(20)) + "\nAb0="
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    headers = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0011AABB\n\n"
    cases = {
        f"see\n{begin}\n{body}\n{end}\nand so on": "see\n[SECRET]\nand so on",
        f"{begin}\r\n{headers}{body}\n{end} x \U0001f600": "[SECRET] x \U0001f600",
        f"a {begin}\n{body}\nSome words, then.": "a [SECRET]Some words, then.",
        f"{begin}\n{headers}{body}": "[SECRET]",
        f"{begin}\n{body}\n{begin}\n{body}\n{end}.": "[SECRET][SECRET].",
        f"key: |\n  {begin}\n  " + body.replace("\n", "\n  "): "key: |\n  [SECRET]",
        '{"k": "' + begin + "\\n" + body.replace("\n", "\\n") + '"}': '{"k": "[SECRET]"}',
        f"a line {begin} starts a key.": "a line [SECRET] starts a key.",
    }
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in secrets.redact(docs, secrets.new_ledger(docs)).collect()}
    assert got == dict(enumerate(cases.values()))


def shingles_of(text):
    found = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def test_fingerprints(documents, texts):
    got = {r.doc_id: r for r in fingerprint.compare_edited(documents).collect()}
    order = sorted(texts.values(), key=lambda r: -r.doc_id)
    off = []
    for i, row in enumerate(order):
        text, after = row.text, order[(i + 1) % len(order)].text
        third = len(text) // 3
        edited = text[:len(text) - third] + after[:third]
        have = got[row.doc_id]
        assert have.n_chars == len(text) and have.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = shingles_of(text), shingles_of(edited), shingles_of(after)
        off += [have.near_edited - len(a & b) / max(1, len(a | b)), have.near_next - len(a & c) / max(1, len(a | c))]
    assert abs(np.mean(off)) < 0.01 and np.max(np.abs(off)) < 0.15
    by_text = {}
    for i, row in texts.items():
        assert by_text.setdefault(row.text, got[i].fingerprint) == got[i].fingerprint


def test_fingerprints_of_odd_rows(odd_docs, odd_rows, no_docs):
    got = fingerprint.compare_edited(odd_docs).collect()
    assert len(got) == len(odd_rows)
    empty = [r for r in got if r.n_chars == 0]
    assert len(empty) == 3 and all(r.fingerprint == "" for r in empty)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert len({(r.fingerprint, r.edited_sha256) for r in got if r.doc_id == 2}) == 1
    assert fingerprint.compare_edited(no_docs).count() == 0


def shares(sizes):
    """Targets by filling up sources one after the other."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        level = (total - sum(3 * sizes[s] for s in full)) / (sum(weight[s] for s in rest) or 1)
        over = {s for s in rest if level * weight[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= over


@pytest.mark.parametrize("table", ["documents", "odd_docs"])
def test_mix_reaches_its_targets(request, table):
    docs = request.getfixturevalue(table)
    source = {}
    size = Counter()
    for r in docs.select("doc_id", "source", "text").collect():
        source[r.doc_id] = r.source
        size[r.source] += len(words_of(r.text))
    want = shares(size)
    got = mixing.mix(docs).groupBy("doc_id", "source", "size", "start", "source_size", "target").agg(
        F.sum("words_used").alias("taken")).collect()
    assert len(got) == docs.count()
    taken = Counter()
    for r in got:
        assert r.taken <= 3 * r.size and r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-6 * (1 + r.target)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    again = {(r.doc_id, r.size, r.taken) for r in mixing.words_taken(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.size, r.taken) for r in got}


def test_repeated_rows_are_documents_each(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 4)
    rows = [(None, None, "a")] * 9 + [(1, "", "a")] * 2 + [(1, "x y z", "a")] * 3 + [(None, "x y", None)] * 13 + [(2, "q " * 300, "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    got = mixing.words_taken(docs).collect()
    want = Counter((i, len(words_of(t))) for i, t, _ in rows)
    assert Counter((r.doc_id, r.size) for r in got) == want
    starts = [(r.source, r.start + k) for r in mixing.placed_documents(docs).collect() for k in range(r.size)]
    assert len(starts) == len(set(starts)) == sum(len(words_of(t)) for _, t, _ in rows)


def test_shards_are_drawn_and_say_where_documents_go(spark):
    """Shards' source counts are draws without replacement from the quotas; the query's shards are those of the mix."""
    words = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.concat(F.lit("w"), i)), " ")
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), words.alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    placed = mixing.placed_documents(docs)
    slots = mixing.slots(mixing.source_plan(placed), per_shard=50).toPandas()
    assert not slots.duplicated(["shard", "slot"]).any()
    counts = slots.groupby(["shard", "rank"]).size().unstack(fill_value=0)
    total = slots["rank"].value_counts()
    n, last = len(slots), slots["shard"].max()
    assert (counts.drop(last).sum(axis=1) == 50).all() and counts.sum().to_dict() == total.to_dict()
    for rank, k in total.items():
        share = k / n
        spread = 50 * share * (1 - share) * (n - 50) / (n - 1)
        drawn = counts.drop(last)[rank]
        assert abs(drawn.mean() - 50 * share) < 4 * (spread / len(drawn)) ** 0.5 + 1 and 0.4 < drawn.var() / spread < 2.2
    mixed = mixing.mix(docs).where("words_used > 0").toPandas().groupby("doc_id")["shard"].agg(["size", "min", "max"])
    got = mixing.words_taken(docs).toPandas().set_index("doc_id")
    assert len(got) == 3000 and (got.n_parts > 0).sum() == len(mixed) and got[got.n_parts == 0].first_shard.isna().all()
    seen = got[got.n_parts > 0].sort_index()
    assert (seen[["n_parts", "first_shard", "last_shard"]].astype(int).to_numpy() == mixed.sort_index().to_numpy()).all()
    assert seen.last_shard.max() > 0


def test_blocks_are_full_and_permutations_are_bijections(spark, documents):
    slots = mixing.mix(documents).where("shard is not null").groupBy("shard", "slot").agg(F.sum("words_used").alias("n")).collect()
    sources = documents.select("source").distinct().count()
    assert sum(r.n != mixing.BLOCK for r in slots) <= 4 * sources
    for n in (1, 2, 7, 1000):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3)).alias("x"))
        assert sorted(r.x for r in got.collect()) == list(range(n))
        back = got.select(mixing._unpermuted(F.col("x"), F.lit(n), F.lit(3)).alias("y"))
        assert sorted(r.y for r in back.collect()) == list(range(n))


def test_mixed_documents_hold_the_words_taken(odd_docs, documents, no_docs):
    for docs in (documents, odd_docs):
        mixed = mixing.mixed_documents(docs)
        assert mixed.columns == docs.columns
        got = Counter()
        for r in mixed.collect():
            got[r.source] += len(words_of(r.text))
            assert r.n_chars == len(r.text)
        sizes = Counter()
        for r in docs.dropDuplicates(["doc_id", "source", "text"]).collect():
            sizes[r.source] += len(words_of(r.text))
        want = shares(sizes)
        assert all(abs(got[s] - want[s]) <= 1 for s in want)
    assert mixing.words_taken(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0

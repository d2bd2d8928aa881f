"""Tokenizers, language identification, the language model, the archive, the join and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tollgate.llm import bpe_codec, hmm, jaccard_join, language_id, mixing, secrets, token_counts, warc
from tollgate.llm.components import connected_components
from tollgate.llm.queries import PIECE_TOKENIZER, WORD_TOKENIZER

WORD_PATH, PIECE_PATH = public_tokenizers.path(WORD_TOKENIZER), public_tokenizers.path(PIECE_TOKENIZER)


def strange_texts():
    rnd = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz ABC'.,é ß́\n\t\x1cΣİ\U0001f600中　▁<|>0123 \x85"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(3000)] + [
        "", " ", "  ", "\n\n  a", "<|endoftext|>a<|startoftext|>  'tis don't", "a" * 9000, "the" * 20000, "日本語" * 400,
        "".join(rnd.choice("etaoinsrh") for _ in range(40000)), "<s>x</s><unk><0x41>",
    ]


def ids_sha(ids):
    return hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def text_sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def strange(spark):
    return spark.createDataFrame(list(enumerate(strange_texts())), "doc_id bigint, text string")


def test_bpe_equals_the_library(documents, odd_docs, strange, no_docs):
    library = Tokenizer.from_file(WORD_PATH)
    for docs in (documents, odd_docs, strange):
        got = sorted(map(str, bpe_codec.round_trip(docs, WORD_PATH).collect()))
        want = []
        for r in docs.select("doc_id", "text").collect():
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            decoded = library.decode(ids, skip_special_tokens=False)
            want.append(f"Row(doc_id={r.doc_id}, n_tokens={len(ids)}, ids_sha256='{ids_sha(ids)}', decoded_sha256='{text_sha(decoded)}')")
        assert got == sorted(want)
    assert bpe_codec.round_trip(no_docs, WORD_PATH).count() == 0


def test_bpe_text_round_trip(spark):
    docs = spark.createDataFrame([(1, "The naïve café \U0001f600 don't 12"), (2, None)], "doc_id bigint, text string")
    back = bpe_codec.decode_documents(bpe_codec.encode_documents(docs, WORD_PATH), WORD_PATH)
    assert {r.doc_id: r.text for r in back.collect()} == {1: "the naïve café \U0001f600 don 't 1 2 ", 2: ""}


def test_transducer_holds_a_bounded_buffer():
    vocabulary = bpe_codec.read_vocabulary(WORD_PATH)
    word = bpe_codec.WordTransducer(vocabulary)
    rnd = random.Random(3)
    data = "".join(rnd.choice("etaoinsrhl") for _ in range(60000)).encode()
    ids, most = [], 0
    for i in range(0, len(data), 1000):
        ids += word.feed(data[i:i + 1000])
        most = max(most, len(word.held))
    ids += word.finish()
    assert most <= 2 * vocabulary.lookahead + 2024
    assert ids == Tokenizer.from_file(WORD_PATH).encode(data.decode(), add_special_tokens=False).ids


def test_transducer_emits_inside_words():
    """Byte by byte, tokens come out before the word ends, and what is held stays short whatever the word's length."""
    vocabulary = bpe_codec.read_vocabulary(WORD_PATH)
    library = Tokenizer.from_file(WORD_PATH)
    word, rnd = bpe_codec.WordTransducer(vocabulary), random.Random(5)
    parts = "inter nation al isation counter revolution aries electro encephalo gram ing ly un break able straße naïve 北京 a e ss th".split()
    cases = ["".join(rnd.choices(parts, k=rnd.randint(1, 12))) for _ in range(400)]
    cases += ["".join(rnd.choices("etaoinsrhlaa", k=rnd.randint(1, 60))) for _ in range(400)]
    cases += ["a" * 3000, "ab" * 1500, "haha" * 700, "é" * 900, "".join(rnd.choices("etaoin", k=20000))]
    early, total, most = 0, 0, 0
    for text in cases:
        text = "".join(c for c in text if c.isalpha())
        ids = []
        for b in text.encode():
            ids += word.feed(bytes([b]))
            most = max(most, len(word.held))
        early += len(ids)
        ids += word.finish()
        total += len(ids)
        assert ids == library.encode(text, add_special_tokens=False).ids
    assert early > total / 2 and most < 256


def test_one_unbroken_word_of_a_megabyte():
    vocabulary = bpe_codec.read_vocabulary(WORD_PATH)
    encoder, rnd = bpe_codec.Encoder(vocabulary), random.Random(6)
    text = "".join(rnd.choices("etaoinsrhldcum", k=1_000_000))
    got, most = [], 0
    for ids in encoder.stream(text.encode()):
        got += ids
        most = max(most, len(encoder.transducer.held))
    assert most < 512 and got == Tokenizer.from_file(WORD_PATH).encode(text, add_special_tokens=False).ids


def test_transducer_does_not_repeat_steps(monkeypatch):
    """Words with the same beginning share its step; ids are the library's, also once what is remembered was given up."""
    vocabulary, library = bpe_codec.read_vocabulary(WORD_PATH), Tokenizer.from_file(WORD_PATH)
    rnd, runs = random.Random(8), []
    for name in ("merged", "merged_long"):
        plain = getattr(bpe_codec, name)
        monkeypatch.setattr(bpe_codec, name, lambda symbols, merges, plain=plain: runs.append(1) or plain(symbols, merges))
    starts, ends = ({"".join(rnd.choices("etaoinsrhlü", k=k)) for _ in range(20)} for k in (9, 5))
    words = [a + b for a in sorted(starts) for b in sorted(ends)]
    want = [library.encode(w, add_special_tokens=False).ids for w in words]
    encoder = bpe_codec.Encoder(vocabulary)
    assert [[i for ids in encoder.stream(w.encode()) for i in ids] for w in words] == want
    assert len(runs) < 1.5 * len(words)
    monkeypatch.setattr(bpe_codec, "REMEMBERED", 7)
    encoder = bpe_codec.Encoder(vocabulary)
    assert [[i for ids in encoder.stream(w.encode()) for i in ids] for w in words] == want
    assert len(encoder.transducer.fed) <= 7 and len(encoder.transducer.ended) <= 7


def test_decoder_keeps_unfinished_characters():
    decoder = bpe_codec.Decoder([b"\xf0\x9f", b"\x98\x80", b"a"])
    assert [decoder.feed([0]), decoder.feed([1, 2]), decoder.feed([0]), decoder.finish()] == ["", "\U0001f600a", "", "�"]


def test_token_counts_equal_the_library(documents, odd_docs, strange, no_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_PATH)
    for docs in (documents, odd_docs, strange):
        got = sorted(map(str, token_counts.count_tokens(docs, PIECE_PATH).collect()))
        want = []
        for r in docs.select("doc_id", "text").collect():
            n = len(library.encode(r.text or ""))
            want.append(f"Row(doc_id={r.doc_id}, n_bytes={len((r.text or '').encode())}, n_tokens={n}, over_limit={n > 4096})")
        assert got == sorted(want)
    assert token_counts.count_tokens(no_docs, PIECE_PATH).count() == 0


def test_language_accuracy(documents, texts):
    rows = language_id.identify(documents).collect()
    assert {r.doc_id for r in rows if r.held_out} == {i for i in texts if zlib.crc32(str(i).encode()) % 5 == 0}
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == texts[r.doc_id].lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) <= 1


def test_language_of_odd_rows(odd_docs, odd_rows, no_docs):
    rows = language_id.identify(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        text = next((row[1] for row in odd_rows if row[0] == r.doc_id), None)
        if r.doc_id is not None and not any(c.isalpha() for c in text or ""):
            assert r.lang_pred == "und" and r.score == 0 and r.rejected
        elif r.doc_id is not None:
            assert r.lang_pred in ("en", "fr")
    kept = language_id.accepted(odd_docs)
    assert kept.columns == odd_docs.columns and not {4, 5, 7, 8} & {r.doc_id for r in kept.collect()}
    assert language_id.identify(no_docs).count() == 0
    assert {r.lang_pred for r in language_id.identify(odd_docs.where("lang is null")).collect()} == {"und"}
    clash = odd_docs.withColumnRenamed("key", "score")
    assert language_id.accepted(clash).columns == clash.columns


def test_accepted_keeps_columns_with_clashing_names(documents):
    marked = documents.select("*", F.lit(1).alias("score"), F.lit(2).alias("own_score"), F.lit(3).alias("_score"), F.lit("x").alias("Rejected"))
    got = language_id.accepted(marked)
    assert got.columns == marked.columns
    rows = got.collect()
    assert {(r.score, r.own_score, r._score, r.Rejected) for r in rows} == {(1, 2, 3, "x")}
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in language_id.accepted(documents).collect())


def test_unlearned_languages_and_garbage_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rnd = random.Random(6)
    odd = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler. " * 3,
        "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz   ") for _ in range(3000)),
        "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(1000)),
    ]
    clean = [
        "Good morning.", "The people of the town went to the market in the morning.", "Le chat dort sur la table de la cuisine.",
        "Die Kinder gehen in die Schule und der Vater geht in das Büro.", "Los niños van a la escuela por la mañana.", "ok",
    ]
    more = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(odd + clean)], docs.schema)
    rows = {r.doc_id: r.rejected for r in language_id.identify(docs.unionAll(more)).collect()}
    assert [rows[-1 - i] for i in range(len(odd + clean))] == [True] * len(odd) + [False] * len(clean)
    assert sum(r for i, r in rows.items() if i >= 0) <= 0.02 * len(rows)


def tokens_of(text):
    return [*(text or "").encode().lower().split(), b""]


def in_training(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 != 1


@pytest.mark.parametrize("table", ["documents", "odd_docs"])
def test_base_scores(request, table):
    docs = request.getfixturevalue(table)
    rows = docs.select("doc_id", "text").collect()
    c = Counter(t for r in rows if in_training(r.doc_id) for t in tokens_of(r.text))
    n, v = sum(c.values()), len(c)
    want = []
    for r in rows:
        found = tokens_of(r.text)
        base = sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in found)
        want.append(str((r.doc_id, not in_training(r.doc_id), len(found), sum(c[t] > 0 for t in found), n, round(base, 6))))
    got = hmm.score(docs, rounds=1).collect()
    assert sorted(want) == sorted(str((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))) for r in got)


def test_language_model_beats_the_base(documents, no_docs):
    rows = hmm.score(documents).toPandas()
    held = rows[rows.held_out]
    assert held.score.sum() > held.base_score.sum() and (held.score > held.base_score).mean() > 0.9
    assert hmm.score(no_docs).count() == 0


def small_model(states=hmm.STATES):
    rnd = np.random.default_rng(2)
    known = np.zeros((states, hmm.CLASSES))
    known[:, :5] = rnd.random((states, 5))
    share = np.zeros(hmm.CLASSES + 1)
    share[:5] = 0.19
    return hmm._model(rnd.random(states), rnd.random((states, states)), known, share, 0.05)


def plain_forward(model, symbols):
    alpha = model.start.astype(float) * model.emissions[:, symbols[0]]
    for s in symbols[1:]:
        alpha = (alpha @ model.moves.astype(float)) * model.emissions[:, s]
    return alpha


def test_forward_and_expected_counts_against_plain_sums():
    model = small_model()
    texts = [[0, 1, 2], [4], [3, 3, 1, 0, 2, 4], [2, 0]]
    flat, lengths = np.array(sum(texts, [])), np.array([len(t) for t in texts])
    want = [math.log(plain_forward(model, t).sum()) for t in texts]
    assert np.allclose(hmm.log_likelihoods(model, flat, lengths), want, rtol=1e-5)
    emissions, moves, starts = hmm._expected(model, flat, lengths)
    e2, m2, s2 = np.zeros_like(emissions), np.zeros_like(moves), np.zeros_like(starts)
    for text in texts:
        alphas = [plain_forward(model, text[:i + 1]) for i in range(len(text))]
        beta, total = np.ones(hmm.STATES), plain_forward(model, text).sum()
        for i in range(len(text) - 1, -1, -1):
            gamma = alphas[i] * beta / total
            e2[:, text[i]] += gamma
            if i:
                m2 += np.outer(alphas[i - 1], model.emissions[:, text[i]] * beta) * model.moves / total
            else:
                s2 += gamma
            beta = model.moves @ (model.emissions[:, text[i]] * beta)
    assert np.allclose(emissions, e2, atol=1e-4) and np.allclose(moves, m2, atol=1e-4) and np.allclose(starts, s2, atol=1e-4)


def test_model_is_a_distribution_over_words(documents):
    blocks = hmm.stored(hmm.packed(documents), "test-blocks")
    listed = blocks.selectExpr("inline(arrays_zip(words, n_train))").where("n_train > 0")
    counts = hmm.stored(listed.groupBy("words").agg({"n_train": "sum"}).toDF("word", "c"), "test-counts")
    n, v = counts.selectExpr("sum(c)", "count(1)").first()
    model = hmm.train(blocks, counts, n, v, rounds=2)
    assert np.allclose(model.emissions.sum(axis=1), 1, atol=1e-4) and np.allclose(model.moves.sum(axis=1), 1, atol=1e-5)
    assert abs(model.share.sum() - 1) < 1e-9


def test_archive_round_trip(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    long = "<p>" + "same " * 40 + "</p>"
    odd = [(9001, "http://a/\r\nx", long), (9000, None, long), (9002, "u", long), (9003, "u", "short"), (9004, "u", "short"),
           (9005, "u", None), (9006, "u", ""), (None, "u", long), (9007, "u", "é\U0001f600" * 60), (9000, "again", long)]
    given = pages.unionByName(spark.createDataFrame(odd, pages.schema)).selectExpr("*", "1 as digest", "'x' as payload")
    archive = warc.new_archive(given)
    warc.write_archive(given, archive)
    rows = warc.read_archive(spark, archive).collect()
    texts = [(r.page_id, r.html or "") for r in given.collect()]
    first = {}
    for i, html in texts:
        if i is not None:
            first[html] = min(first.get(html, i), i)
    want = []
    for i, html in texts:
        data = html.encode()
        revisit = len(data) >= 100 and i != first[html]
        want.append(str((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first[html] if revisit else None)))
    assert sorted(want) == sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in rows)
    assert spark.read.parquet(f"{archive}/payloads").count() == len({html for _, html in texts})
    # Records parse by their own headers, and responses carry the exact bytes.
    html_of = defaultdict(set)
    for i, html in texts:
        html_of[i].add(html.encode())
    for r in warc.records(warc.read_archive(spark, archive)).collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        size = int(fields["Content-Length"])
        assert rest[size:] == b"\r\n\r\n" and head.startswith(b"WARC/1.1")
        if fields["WARC-Type"] == "response":
            assert rest[:size] in html_of[r.page_id]


def test_damaged_payload_stops_the_read(spark):
    pages = spark.createDataFrame([(1, "u", "text")], "page_id bigint, url string, html string")
    archive = warc.new_archive(pages)
    warc.write_archive(pages, archive)
    stored = spark.read.parquet(f"{archive}/payloads")
    stored.selectExpr("digest", "encode('other', 'UTF-8') payload").write.parquet(f"{archive}-bad/payloads")
    spark.read.parquet(f"{archive}/records").write.parquet(f"{archive}-bad/records")
    with pytest.raises(Exception, match="payload differs"):
        warc.read_archive(spark, f"{archive}-bad").collect()


def test_empty_archive(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    archive = warc.new_archive(pages)
    warc.write_archive(pages, archive)
    assert warc.read_archive(spark, archive).count() == 0


def set_of(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(found[i:i + 4]) for i in range(max(1, len(found) - 3))) if found else frozenset()


def brute_components(rows):
    """(row number -> component id), over (doc_id, text) rows."""
    sets = [set_of(t) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for k in s:
            holders[k].append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        shared = Counter(j for k in s for j in holders[k] if j > i)
        for j, c in shared.items():
            if 100 * c >= 85 * (len(s) + len(sets[j]) - c):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    out = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out[i] = (min(ids) if ids else None) if sets[i] else rows[i][0]
    return sets, out


def families(rnd, n_groups, size, words=120, passage=()):
    """Texts in groups of near copies, around the threshold, with a passage that all share."""
    rows, vocabulary = [], [f"w{i}" for i in range(5000)]
    for _ in range(n_groups):
        base = [rnd.choice(vocabulary) for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rnd.randint(0, 5)):
                text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
            rows.append((len(rows), " ".join([*passage, *text])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("case", ["odd", "families", "large_group", "passages", "short"])
def test_components_equal_brute_force(spark, odd_docs, odd_rows, case):
    rnd = random.Random(11)
    if case == "odd":
        rows, docs = [r[:2] for r in odd_rows], odd_docs
    else:
        passage = [f"p{i}" for i in range(90)]
        rows = {
            "families": lambda: families(rnd, 40, 6), "large_group": lambda: families(rnd, 2, 150) + families(rnd, 10, 3),
            "passages": lambda: families(rnd, 60, 1, 60, passage) + [(1000 + i, " ".join([*passage, f"q{i}"])) for i in range(50)],
            "short": lambda: [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 8)))) for i in range(400)],
        }[case]()
        rows = [(i, t) for i, (_, t) in enumerate(rows)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets, want = brute_components(rows)
    got = jaccard_join.link_components(docs, jaccard_join.Join(frequent=5 if case != "odd" else 33)).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == sorted(
        str((rows[i][0], len(sets[i]), want[i])) for i in range(len(rows)))


def test_join_of_no_rows_and_one_of_each(no_docs, odd_docs, odd_rows):
    assert jaccard_join.link_components(no_docs).count() == 0
    kept = jaccard_join.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and not ids[2] and ids[4] == ids[5] == ids[7] == 1


def test_one_row_of_each_group_whatever_its_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(1, a, "s"), (None, a, "s"), (None, a, "t"), (1, a, "s"), (1, a, "u"), (None, b, "s"), (None, b, "s"), (None, b + " more", "s"),
            (2, c, "s"), (2, c, "s"), (2, d, "s"), (3, d, "s"), (None, None, "s"), (None, " ", "s"), (None, " ", "s"), (4, "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    kept = [(r.doc_id, r.text) for r in jaccard_join.one_of_each(docs).collect()]
    with_words = sorted(((i, (t or "")[0]) for i, t in kept if (t or "").strip()), key=str)
    assert with_words == [(1, "a"), (2, "c"), (2, "d"), (None, "b")]
    assert sorted(map(str, (k for k in kept if not (k[1] or "").strip()))) == sorted(
        map(str, [(None, None), (None, " "), (None, " "), (4, "")]))


def test_near_duplicates_of_the_pipeline_are_five_words_at_80_percent(spark, sf_dir):
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(500)]
    footer = [f"f{i}" for i in range(100)]
    scattered = list(base)
    for k in range(11):
        scattered[20 + 42 * k] = f"c{k}"
    apart = list(base)
    for k in range(14):
        apart[20 + 33 * k] = f"d{k}"
    texts = [(1, base), (2, base + footer), (3, scattered), (4, apart), (5, [rnd.choice(base) for _ in range(300)])]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts], "doc_id bigint, text string")
    # Five-word Jaccard to the first: 0.832, 0.800, 0.75. By four words at 85 % all would stay.
    kept = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5]


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    edges = spark.createDataFrame([*path, *star, (5, 5), (3, 2)], "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(1, 50)}}


def test_pipeline_stages_against_brute_force(spark, documents, sf_dir):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    out, docs = {}, documents
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), f"test-{name}")
        out[name] = docs.collect()
        if name != names[-1]:
            assert docs.columns == documents.columns
    given = documents.collect()
    kept = {r.doc_id for r in out["language_filter"]}
    assert len(kept) >= len(given) - 1
    rows = [(r.doc_id, r.text) for r in out["language_filter"]]
    _, component = brute_components(rows)
    assert sorted(r.doc_id for r in out["near_duplicates"]) == sorted(i for n, (i, _) in enumerate(rows) if component[n] == i)
    before = {r.doc_id: r.text for r in out["near_duplicates"]}
    for r in out["secret_scan"]:
        spans = [m.span() for m in re.finditer(r"[0-9a-f]{32,}|AKIA[A-Z0-9]{12,}", r.text)]
        assert not spans and (r.text == before[r.doc_id] or "[SECRET]" in r.text)
    assert len(out["secret_scan"]) == len(before)
    library = Tokenizer.from_file(WORD_PATH)
    want = Counter(ids_sha(library.encode(r.text, add_special_tokens=False).ids) for r in out["source_mixing"])
    assert want == Counter(r.ids_sha256 for r in out["bpe_encoding"])
    assert all(r.n_tokens == len(r.ids) and ids_sha(r.ids) == r.ids_sha256 for r in out["bpe_encoding"])
    assert sorted(str(r) for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(str(r) for r in out["bpe_encoding"])
    assert mixing and secrets


def _labelled_texts(spark, n):
    """Two languages; the rows behind the first fifth hold letters that no other row has."""
    rnd = random.Random(11)
    stems = {"en": "the of and people town market river house".split(), "fr": "le la des gens ville marché rivière maison".split()}
    rows = []
    for i in range(n):
        lang = "en" if i % 2 else "fr"
        more = [chr(0x3B1 + i % 24) * (1 + i % 5)] if i > n // 5 else []
        rows.append((i, " ".join(rnd.choices(stems[lang], k=rnd.randint(1, 40)) + more), lang))
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_language_model_learns_from_all_texts(spark):
    """Document frequencies, centroids and limits are those of a plain loop over all training texts, whatever the sample is."""
    rows, docs = _labelled_texts(spark, 5600)
    model = language_id.fit(docs, sample=20)
    letters = language_id.Letters()
    known = [(text, lang) for i, text, lang in rows if zlib.crc32(str(i).encode()) % 5]
    assert min(Counter(lang for _, lang in known).values()) > 2000
    counts = np.array([language_id.gram_counts(text, letters) for text, _ in known])
    idf = np.log((len(counts) + 1) / ((counts > 0).sum(axis=0) + 1)) + 1
    assert np.allclose(model.idf, idf, atol=1e-5)

    vectors = language_id.weighted(counts, model.idf)
    want = np.zeros_like(model.limits)
    near, classes = {}, {}
    for number, name in enumerate(model.languages):
        own = model.centroids[model.owner == number]
        mine = vectors[[lang == name for _, lang in known]]
        nearest = (mine @ own.T).argmax(axis=1)
        for k, centre in enumerate(own):  # after the last round the texts may still change their centre, a few of them
            mean = mine[nearest == k].mean(axis=0)
            assert centre @ mean / np.linalg.norm(mean) > 0.99
        pieces = np.array([language_id.gram_counts(t, letters) for text, lang in known if lang == name for t in language_id.cuts(text)])
        near[number] = (np.clip((language_id.weighted(pieces, model.idf) @ own.T).max(axis=1), 0, 1) / language_id.STEP).astype(int)
        classes[number] = language_id.length_class(pieces)

    def farthest(steps):
        steps = np.sort(steps)
        return language_id.STEP * steps[int(language_id.FARTHEST * len(steps))]

    for k in range(want.shape[1]):
        everyone = np.concatenate([near[i][classes[i] == k] for i in near])
        for i in near:
            steps = near[i][classes[i] == k]
            if len(steps):
                want[i, k] = language_id.SLACK[k] * min(farthest(steps), farthest(everyone)) * len(steps) / (len(steps) + language_id.FEW)
    assert np.allclose(model.limits, want, atol=0.0021)
    # A cut for every class that the text is longer than.
    assert [len(language_id.cuts("ab " * n)) for n in (1, 10, 100)] == [1, 4, 7]


def test_language_whose_sample_has_no_letters_is_learned(spark):
    rows = [(i, "12 34" if i < 4000 else "nine words of plain text are in this row", "en") for i in range(4003)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert language_id.fit(docs, sample=1).languages == ["en"]

"""The prefix trie, periodic runs and the piece codec against brute force, the library and on odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tollgate.llm import piece_codec, prefix_trie, queries, runs

PIECE_PATH = public_tokenizers.path(queries.PIECE_TOKENIZER)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def bag(rows):
    return Counter(map(str, rows))


# Pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return piece_codec.Vocabulary(PIECE_PATH)


def strange_texts():
    rnd = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz ABC'.,é ß́\n\t\x1cΣİ\U0001f600中　▁<|>0123 \x85\0"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(2000)] + [
        "", " ", "  ", "\n\n  a", "a" * 9000, "the" * 20000, "日本語" * 400, "<s>x</s><unk><0x41>", " " * 5000, "aab" * 3000,
        "".join(rnd.choice("etaoinsrh") for _ in range(40000)), "-" * 4999,
    ]


def test_pieces_equal_the_library(spark, documents, odd_docs, no_docs, library):
    strange = spark.createDataFrame(list(enumerate(strange_texts())), "doc_id bigint, text string")
    for docs in (documents, odd_docs, strange):
        encoded = piece_codec.encode_documents(docs, PIECE_PATH)
        want = []
        for r in docs.select("doc_id", "text").collect():
            ids = library.encode(r.text or "")
            want.append((r.doc_id, ids, library.decode(ids)))
        got = [tuple(r) for r in piece_codec.decode_documents(encoded, PIECE_PATH).collect()]
        assert bag(got) == bag(want)
    assert piece_codec.decode_documents(piece_codec.encode_documents(no_docs, PIECE_PATH), PIECE_PATH).count() == 0


def test_piece_query(spark, sf_dir, documents, library):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_piece_round_trip(spark, sf_dir).collect()}
    want = {}
    for r in documents.select("doc_id", "text").collect():
        ids = library.encode(r.text or "")
        want[r.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    assert got == want


def test_decoder_of_any_ids(vocabulary, library):
    rnd = random.Random(11)
    decoder = piece_codec.Decoder(vocabulary)
    for _ in range(3000):
        ids = [rnd.choice([0, 1, 2, rnd.randrange(3, 259), rnd.randrange(32000)]) for _ in range(rnd.randint(0, 8))]
        assert decoder.decode(ids) == library.decode(ids), ids


def test_one_unbroken_word_of_a_million_letters(vocabulary, library):
    rnd = random.Random(2)
    text = "".join(rnd.choice("etaoinsrhl") for _ in range(1_000_000))
    [ids] = piece_codec.Encoder(vocabulary).encode([text])
    assert ids.tolist() == library.encode(text)


def test_remembered_words_are_bounded(vocabulary, library, monkeypatch):
    monkeypatch.setattr(piece_codec, "REMEMBERED", 50)
    monkeypatch.setattr(piece_codec, "GROUP_CHARS", 100)
    rnd = random.Random(4)
    encoder = piece_codec.Encoder(vocabulary)
    for _ in range(30):
        texts = [" ".join("".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 90))) for _ in range(20)) for _ in range(3)]
        assert [ids.tolist() for ids in encoder.encode(texts)] == library.encode(texts)
        assert len(encoder.known) <= 50


def test_better_pairs_opened_by_a_merge_go_first():
    """A vocabulary in which a merge opens a pair of better rank, against one merge at a time."""
    pieces = {"ab": 5, "ba": 3, "aba": 1, "bab": 2, "abab": 4, "aa": 6, "bb": 7, "aab": 0}
    made = piece_codec.Vocabulary.__new__(piece_codec.Vocabulary)
    names = {name: i for i, name in enumerate([*"ab", *pieces])}
    pairs = {names[p[:k]] << 32 | names[p[k:]]: (pieces[p], names[p]) for p in pieces for k in range(1, len(p)) if p[:k] in names and p[k:] in names}
    made.size, made.keys = len(names), np.array(sorted(pairs), np.int64)
    made.ranks, made.merged = np.array([pairs[k] for k in sorted(pairs)], np.int32).T.copy()
    made.chars = {ord(c): names[c] for c in "ab"}
    made.joined = np.array(sorted(ord(x) << 21 | ord(y) for x in "ab" for y in "ab"), np.int64)
    merger, rnd = piece_codec.Merger(made), random.Random(8)
    words = ["".join(rnd.choice("ab") for _ in range(rnd.randint(1, 30))) for _ in range(500)]
    for word, packed in zip(words, merger.encode(words)):
        now = list(word)
        while True:
            best = min(((pieces[a + b], i) for i, (a, b) in enumerate(zip(now, now[1:])) if a + b in pieces), default=None)
            if best is None:
                break
            now[best[1]:best[1] + 2] = ["".join(now[best[1]:best[1] + 2])]
        assert np.frombuffer(packed, np.int32).tolist() == [names[p] for p in now]


# Runs


def brute_runs(words):
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    x = np.array([number[w] for w in words], np.int64)
    n, found = len(x), {}
    for q in range(1, n // 2 + 1):
        same = np.r_[False, x[:-q] == x[q:], False]
        change = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(change[::2].tolist(), change[1::2].tolist()):
            if b - a + q >= max(12, 2 * q):
                found.setdefault((a, b + q), q)  # the smallest period comes first
    return sorted((a, q, b - a) for (a, b), q in found.items())


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def collapsed(words, found):
    dropped = {i for a, q, length in found for i in range(a + q, a + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def run_facts(doc_id, text, change=False):
    words = WORD.findall(text or "")
    words = planted(words, doc_id) if change else words
    found = brute_runs(words)
    return doc_id, len(words), [(a, length, q) for a, q, length in found], sha(collapsed(words, found))


def found_facts(df):
    return [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed_sha256) for r in df.collect()]


def test_runs_of_documents(spark, sf_dir, documents):
    rows = documents.select("doc_id", "text").collect()
    want = {r.doc_id: run_facts(r.doc_id, r.text, change=True) for r in rows}
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, sf_dir).collect()}
    assert got.keys() == want.keys()
    for i, (_, _, found, kept) in want.items():
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{a},{length},{q}\n" for a, length, q in found)
        first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(found), *first)
        assert (r.runs_sha256, r.collapsed_sha256) == (sha(lines), kept)


def periodic_texts():
    rnd, out = random.Random(13), []
    for _ in range(400):
        words, kinds = [], rnd.choice([1, 2, 2, 3, 5, 50])
        while len(words) < rnd.randint(0, 250):
            if rnd.random() < 0.5 and words:
                p = rnd.randint(1, min(len(words), 60))
                for _ in range(rnd.randint(1, 150)):
                    words.append(words[-p])
            else:
                words += [f"w{rnd.randrange(kinds)}" for _ in range(rnd.randint(1, 20))]
        out.append(rnd.choice(" \n\t").join(words))
    return out


def test_runs_against_brute_force(spark, odd_docs, odd_rows, no_docs):
    texts = [(i % 50 or None, t) for i, t in enumerate(periodic_texts())]  # ids are repeated and missing
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    assert bag(found_facts(runs.find_runs(docs))) == bag(run_facts(*r) for r in texts)
    assert bag(found_facts(runs.find_runs(odd_docs, planted=True))) == bag(run_facts(*r[:2], change=True) for r in odd_rows)
    assert runs.find_runs(no_docs).count() == 0


def test_runs_of_very_long_texts(spark):
    block = [f"w{i}" for i in range(30000)]
    texts = ["mot " * 100_000, " ".join(block * 3), "x" * 2_000_000, " ".join(f"u{i}" for i in range(200_000)), "a b " * 40_000 + "c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in runs.find_runs(docs).collect()}
    assert got == {0: [(0, 100_000, 1)], 1: [(0, 90_000, 30_000)], 2: [], 3: [], 4: [(0, 80_000, 2)]}


def test_runs_of_many_copies_and_missing_ids(spark):
    text = "one two three four five six " * 3 + "end"
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).cast("bigint").alias("doc_id"),
        F.when(F.col("id") % 3 == 1, F.concat(F.lit("word "), F.col("id").cast("string"))).otherwise(F.lit(text)).alias("text"))
    got = runs.find_runs(docs).groupBy(F.size("runs").alias("n")).count().collect()
    assert {r.n: r["count"] for r in got} == {0: 1000, 1: 2000}
    prepared = runs._prepared(docs, False)
    assert runs._fragments(prepared).count() == 2000  # one tile of one octave a periodic text


# Trie


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256((str(len(role.encode())) + ":" + role + text).encode()).hexdigest()[:32]
            own[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        block = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(block, [])[:h] + turns[h:]
    return out


def brute_trie(paths):
    members, kids = defaultdict(list), defaultdict(set)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            kids[node[:-1]].add(node)
    facts = {}
    for node in sorted(members, key=len, reverse=True):
        below = [facts[k] for k in kids[node]]
        saved = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0) + sum(b[5] for b in below)
        ends = ",".join(map(str, sorted(c for c in members[node] if len(paths[c]) == len(node))))
        facts[node] = (min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                       len(below), saved, sum(b[6] for b in below) or 1, sha(ends))
    return facts.values()


def trie_facts(df):
    return [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.saved_tokens, r.n_leaves, r.ends_sha256) for r in df.collect()]


LAYOUT = "conv_id bigint, turn int, role string, text string, path string, sizes int, part int, own int, piece int, n int"


def conversations_of(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2, 3, 4, 5) for r in rows], LAYOUT).repartition(3)


def test_trie_of_conversations(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert bag(trie_facts(prefix_trie.build_trie(table))) == bag(brute_trie(rebuilt(rows)))


def test_trie_of_odd_conversations(spark):
    rnd, rows = random.Random(17), []
    for c in [None, *range(-12, 90), 10**12]:
        for turn in range(rnd.randint(1, 9)):
            rows.append((c, rnd.choice([turn, turn, None]), rnd.choice(["u", None, "é"]), rnd.choice(["yes", "no", None, "", "é" * 40])))
    rows += [(7, 3, "u", "yes")] * 5 + [(c, 50, "u", "x" * 300_000) for c in (1, 2)]
    got = trie_facts(prefix_trie.build_trie(conversations_of(spark, rows)))
    assert bag(got) == bag(brute_trie(rebuilt(rows)))


def test_trie_of_hot_conversations(spark):
    """A third of all turns in one conversation, and a third of all conversations alike."""
    rows = [(3, t, "u", f"t{t % 7}") for t in range(6000)] + [(10 * c, t, "u", f"same{t}") for c in range(1, 1500) for t in range(2)]
    rows += [(10 * c + 20000, t, "u", f"{c % 40} {t}") for c in range(1500) for t in range(2)]
    got = trie_facts(prefix_trie.build_trie(conversations_of(spark, rows)))
    assert bag(got) == bag(brute_trie(rebuilt(rows)))


def test_trie_of_nothing(spark):
    assert prefix_trie.build_trie(conversations_of(spark, [(None, 1, "u", "t")])).count() == 0
    [root] = trie_facts(prefix_trie.build_trie(conversations_of(spark, [(2, 0, "u", "t")])))  # base absent, its turn is a head
    assert root == (2, 0, None, 1, 0, 0, 1, sha("2"))


def test_boundaries_may_cut_anywhere():
    rnd = random.Random(3)
    for _ in range(1500):
        paths = {c: [("u", rnd.choice(["x", "yyyy"])) for _ in range(rnd.randint(0, 6))] for c in range(rnd.randint(1, 30))}
        copies = defaultdict(list)
        for c, turns in paths.items():
            copies[tuple(turns)].append(c)
        rows = sorted((b"".join(hashlib.sha256(t.encode()).digest()[:16] for _, t in turns), [len(t) for _, t in turns], len(m), min(m),
                       sha(",".join(map(str, sorted(m))))) for turns, m in copies.items())
        cuts = sorted(rnd.sample(range(1, len(rows)), min(len(rows) - 1, rnd.randint(0, 4))))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        edges = [-1, *(prefix_trie.common_turns(a[-1][0], b[0][0]) for a, b in zip(parts, parts[1:])), -1]
        nodes = [n for i, p in enumerate(parts) for n in prefix_trie.partition_nodes(p, edges[i], edges[i + 1])]
        opened = {}
        for n in (n for n in nodes if n[8]):
            a = opened.get(n[8])
            opened[n[8]] = [n[0], min(n[1], a[1]), *(n[i] + a[i] for i in range(2, 6)), n[6] or a[6], None, n[8], n[9]] if a else n
        every = [n for n in nodes if not n[8]] + list(opened.values())
        got = [(n[1], n[0], opened[n[9]][1] if n[9] else n[7], n[2], n[3], n[5], n[4], n[6] or prefix_trie.NOTHING) for n in every]
        assert bag(got) == bag(brute_trie(paths))

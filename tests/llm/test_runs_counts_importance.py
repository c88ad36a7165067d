"""Periodic runs, token counts, importance resampling: against brute force and the library, with the awkward rows of every kind."""
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chartfold.llm import importance, periodic_runs, pretokens, queries, radix_sort, token_counts

SCHEMA = "doc_id long, text string, row long, digit int, block long, piece string, score string, n_words string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 3, 4, 5, "p", "s", "w") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    out = []
    for i in range(90):
        n = int(rng.integers(0, 140))
        w = rng.integers(0, int(rng.integers(1, 40)), n)
        if n > 12 and i % 2:
            a, p = int(rng.integers(0, n - 8)), int(rng.integers(1, 4))
            w[a:] = w[a + (np.arange(n - a)) % p] if p <= n - a else w[a:]
        out.append((i, "".join(f"W{x}" + str(rng.choice([" ", "\n", "  ", "\t"])) for x in w)))
    line = "they don't say it's été 中文 ½ ..."
    out += [(200, ""), (201, None), (202, "a"), (203, "a b " * 6000), (204, "x" * 90_000), (205, line), (205, line), (205, "other words " * 12),
            (None, "ab cd " * 30), (None, None), (206, "z <|endoftext|> z😀 ok"), (207, " \n\t "), (-5, "neg ative " * 20)]
    return out


# ---------------------------------------------------------------- periodic runs

def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(6, 4 * q):
                found.setdefault((s, i - s + q), q)
            i += i == s
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_document(doc_id, text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    from fractions import Fraction
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *head, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_document_runs(spark, rows):
    got = [tuple(r) for r in periodic_runs.document_runs(frame(spark, rows)).collect()]
    want = [brute_document(*r) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[1] for r in want) > 40


def test_runs_of_whole_small_table(spark, small_dir):
    import duckdb
    docs = duckdb.sql(f"select doc_id, text from '{small_dir}/documents.parquet' order by length(text) limit 150").fetchall()
    got = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, small_dir).collect()}
    assert all(got[i] == brute_document(i, t) for i, t in docs)


def test_extensions_against_comparison():
    rng = np.random.default_rng(2)
    for size, vocabulary in ((40, 2), (300, 2), (700, 1), (500, 3)):
        w = rng.integers(0, vocabulary, size)
        w[size // 2:] = w[:size - size // 2]
        e = periodic_runs.Extensions(w)
        i, j = rng.integers(0, size, 400), rng.integers(0, size, 400)
        i, j = i[i != j], j[i != j]
        want = [next((k for k in range(size) if max(a, b) + k >= size or w[a + k] != w[b + k]), 0) for a, b in zip(i, j)]
        assert e.extend(i, j).tolist() == want


def test_only_cover_samples_are_sorted():
    e = periodic_runs.Extensions(np.arange(1300) % 7)
    assert len(e.rank) == 1300 * len(periodic_runs.COVER) // periodic_runs.V
    assert all(any((a + d) % 13 in periodic_runs.COVER and (b + d) % 13 in periodic_runs.COVER for d in range(13)) for a in range(13) for b in range(13))


def test_strongest_run_is_compared_exactly():
    big = 10 ** 9
    runs = np.array([(0, 4 * big + 1, big), (1, 4 * (big + 1) + 1, big + 1), (2, 4 * (big - 1) + 1, big - 1)])
    assert periodic_runs.strongest(runs)[0] == 2


# ---------------------------------------------------------------- token counts

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.byte_bpe_path())


def test_count_tokens(spark, rows, library):
    got = [tuple(r) for r in token_counts.count_tokens(frame(spark, rows), queries.byte_bpe_path()).collect()]
    want = []
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 1024))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_counts_of_the_whole_small_table(spark, small_dir, library):
    import duckdb
    docs = duckdb.sql(f"select doc_id, text from '{small_dir}/documents.parquet'").fetchall()
    got = {r.doc_id: r.n_tokens for r in queries.op12_token_counts(spark, small_dir).collect()}
    assert got == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in docs}


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_vocabularies_get_whole_texts(spark, rows, name):
    import public_tokenizers
    path = public_tokenizers.path(name)
    got = [(r.doc_id, r.n_tokens) for r in token_counts.count_tokens(frame(spark, rows), path).collect()]
    if name.endswith(".model"):
        import sentencepiece
        encode = sentencepiece.SentencePieceProcessor(model_file=path).encode
    else:
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)

        def encode(x):
            return t.encode(x, add_special_tokens=False).ids
    assert sorted(got, key=str) == sorted(((i, len(encode(x or ""))) for i, x in rows), key=str)


def random_texts(rng, n):
    signs = list("aabcstmdrevl''   \t\n\r.!—é1²½ñ中") + [" ", "​", "\x1c", "\x85", "\xa0", "᠎", "\x00", "'s", "'re", "'ll ", "'d", "<|endoftext|>", "😀", "ꟊ"]
    return ["".join(rng.choice(signs, rng.integers(0, 24))) for _ in range(n)]


def test_pieces_are_those_of_the_library(library):
    classes = pretokens.character_classes()
    rng = np.random.default_rng(3)
    held = 0
    for text in random_texts(rng, 6000):
        raw = np.frombuffer(text.encode(), np.uint8)
        if not len(raw):
            continue
        edges = np.zeros(len(raw) + 1, bool)
        edges[[0, -1]] = True
        starts, odd = pretokens.piece_starts(raw, edges, classes)
        if not len(odd):
            held += 1
            assert starts.tolist() == [len(text[:a].encode()) for _, (a, _) in library.pre_tokenizer.pre_tokenize_str(text)], repr(text)
    assert held > 1000


@pytest.mark.parametrize("table", [None, "some", "empty"])
def test_tables_decide_speed_only(library, table, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)               # the cache forgets all the time
    texts = random_texts(np.random.default_rng(4), 4000)
    lib = token_counts.Library(queries.byte_bpe_path())
    pieces = [b" ab", b"ab", b"a", b" ", b"a\x00", b"'s", b"1"] if table == "some" else []
    raw, n = np.frombuffer(b"".join(pieces), np.uint8), np.array([len(p) for p in pieces], np.int64)
    held = None if table is None else token_counts.LengthTable(
        token_counts.piece_keys(raw, np.cumsum(n) - n, n), np.array(lib.count([p.decode() for p in pieces]) if pieces else [], np.int32))
    got = token_counts.count_texts(pa.array(texts), lib, pretokens.character_classes(), held)
    assert got.tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert len(lib.young) + len(lib.old) < 50 + 2 * 4000


def test_table_keys_are_exact():
    pieces = [bytes([a, b]) for a in range(60) for b in range(60)] + [b"x" * k for k in range(24)] + [b"x" + b"\0" * k for k in range(23)]
    pieces = list(dict.fromkeys(pieces))
    n = np.array([len(p) for p in pieces])
    keys = token_counts.piece_keys(np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(n) - n, n)
    table = token_counts.LengthTable(keys, np.arange(len(pieces), dtype=np.int32))
    assert table.find(keys).tolist() == list(range(len(pieces)))
    assert [token_counts.key_bytes(k) for k in keys.T] == pieces
    keys[2] += np.uint64(1) << np.uint64(48)
    assert (table.find(keys) == -1).all()


def test_the_summary_holds_the_frequent_pieces(spark):
    docs = spark.createDataFrame([(" the of" * 50 + f" rare{i}",) for i in range(200)], "text string")
    table = token_counts.frequent_lengths(docs, queries.byte_bpe_path(), 5)
    p = [b" the", b" of"]
    n = np.array([4, 3])
    assert table.find(token_counts.piece_keys(np.frombuffer(b"".join(p), np.uint8), np.cumsum(n) - n, n)).tolist() == [1, 1]
    assert (table.counts >= 0).sum() == 5


# ---------------------------------------------------------------- importance resampling

def brute_resample(rows, target, percent, least, seed, buckets, ngrams):
    def features(text):
        w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))
        return len(w), [zlib.crc32(b" ".join(w[i:i + k])) % buckets for k in range(1, ngrams + 1) for i in range(len(w) - k + 1)]
    made = [(i, *features(t)) for i, t in rows]
    s, t = Counter(b for _, _, f in made for b in f), Counter(b for x in target for b in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out, drawn = [], []
    for k, (i, n, f) in enumerate(made):
        weight = sum(gain[b] for b in f)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n >= least:
                drawn.append((-score, i, k))
        out.append([i, len(f), weight, score, None])
    for r, (_, _, k) in enumerate(sorted(drawn)[:percent * len(drawn) // 100]):
        out[k][4] = r + 1
    return [tuple(x) for x in out]


@pytest.mark.parametrize("ngrams,percent", [(1, 10), (2, 100), (3, 37)])
def test_resample(spark, rows, ngrams, percent):
    target = ["w1 w2 w3 w5", "W7 w8", None, "", "they say it is"]
    rows = [r for k, r in enumerate(rows) if r[0] != 205 or k == len(rows) - 1] + [(205, "some words " * 15)] * 2 + [(205, "other words " * 12)]
    got = importance.resample(frame(spark, rows), spark.createDataFrame([(t, 1) for t in target], "text string, gain int"),
                              percent=percent, least_words=12, buckets=97, ngrams=ngrams)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = brute_resample(rows, target, percent, 12, 2024, 97, ngrams)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)


def test_radix_sort_of_hot_digits_and_wide_keys(spark):
    rng = np.random.default_rng(6)
    keys = [(int(rng.choice([0, 7, 7, 7, (1 << 62) - 1])), int(rng.integers(0, 1 << 31))) for _ in range(900)] + [(7, 5)] * 300
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(keys)], "id long, a long, b long")
    digits = radix_sort.digits_of([(F.col("a"), 62), (F.col("b"), 31)])
    assert len(digits) == -(-93 // radix_sort.DIGIT_BITS)
    got = {r.place: (r.a, r.b) for r in radix_sort.radix_sort(df, digits, len(keys), F.col("id")).collect()}
    assert [got[k] for k in range(len(keys))] == sorted(keys)


def test_crc32_of_spans():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, 4000).astype(np.uint8)
    starts, n = rng.integers(0, 3900, 300), rng.integers(0, 100, 300)
    assert importance.crc32_spans(raw, starts, n).tolist() == [zlib.crc32(raw[a:a + k].tobytes()) for a, k in zip(starts, n)]


# ---------------------------------------------------------------- all three

def test_empty_tables(spark):
    docs = frame(spark, [])
    assert periodic_runs.document_runs(docs).collect() == []
    assert token_counts.count_tokens(docs, queries.byte_bpe_path()).collect() == []
    assert importance.resample(docs, docs).collect() == []
    few = frame(spark, [(1, None), (2, "")])
    assert [r.n_tokens for r in token_counts.count_tokens(few, queries.byte_bpe_path()).collect()] == [0, 0]
    assert [(r.weight, r["rank"]) for r in importance.resample(few, docs).collect()] == [(0, None)] * 2


def test_no_texts_are_shuffled(spark, small_dir, capsys):
    for q in (queries.op11_periodic_runs, queries.op12_token_counts):
        q(spark, small_dir).explain()
        assert "Exchange" not in capsys.readouterr().out

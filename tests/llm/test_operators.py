"""Operators on small fixtures: brute force, nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""
import hashlib
import os
import zlib

import numpy as np
import pytest

from chartfold.llm import (decontaminate, fingerprint, line_dedup, mixing, ngram_join, queries, sharding, token_files, toxicity, url_filter, warc)

SCHEMA = "doc_id long, text string, lang string, sid string, part int, key string, label string, row string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", 7, "k", "l", "r") for i, t in rows], SCHEMA)


def words(rng, n, vocab=400):
    return " ".join(f"w{x}" for x in rng.integers(0, vocab, n))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    base = [words(rng, int(n)) for n in (3, 12, 40, 160, 700)]
    out = [(i, t) for i, t in enumerate(base)]
    for k in range(60):                                 # near copies with more and more changed words
        w = base[3].split()
        for j in rng.integers(0, len(w), k // 12):
            w[j] = f"z{rng.integers(0, 30)}"
        out.append((100 + k, " ".join(w)))
    out += [(200, base[2].upper()), (201, base[2]), (202, ""), (203, None), (204, "a"), (205, "A"), (206, "x" * 90_000)]
    out += [(207, "same line here\nother\n" * 40), (207, "same line here\nother\n" * 40), (None, "same line here"), (208, " Same Line HERE \nq")]
    return out


def brute_sets(rows):
    out = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        out.append((i, frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    return out


def test_ngram_join(spark, rows):
    sets = brute_sets(rows)
    label = list(range(len(sets)))
    for _ in sets:
        for a, (_, x) in enumerate(sets):
            for b, (_, y) in enumerate(sets):
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
        if all(label[label[a]] == label[a] for a in range(len(sets))):
            break
    want = []
    for a, (i, s) in enumerate(sets):
        ids = [j for b, (j, _) in enumerate(sets) if label[b] == label[a] and j is not None]
        want.append((i, len(s), min(ids) if s and ids else i))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_ngram_links(spark, rows):
    sets = brute_sets(rows)
    want = [(i, sum(100 * len(x & y) >= 80 * len(x | y) for b, (_, y) in enumerate(sets) if a != b and x and y)) for a, (i, x) in enumerate(sets)]
    made = ngram_join.jaccard_links(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_links) for r in made), key=str) == sorted(want, key=str)
    assert max(n for _, n in want) > 20
    parts = ngram_join.jaccard_components(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.component_id) for r in made), key=str) == sorted(((r.doc_id, r.component_id) for r in parts), key=str)


def test_fingerprints(spark, rows):
    got = fingerprint.fingerprint_documents(frame(spark, [r for r in rows if r[0] != 207])).collect()
    ordered = sorted(((i if i is not None else -1, t or "") for i, t in rows if i != 207))
    by = {(-1 if r.doc_id is None else r.doc_id): r for r in got}
    assert len(got) == len(ordered)
    for (i, t), (_, n) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(t) // 2
        assert by[i].n_chars == len(t)
        assert by[i].edited_sha256 == hashlib.sha256((t[:len(t) - half] + n[:half]).encode()).hexdigest()
        assert 0 <= by[i].near_edited <= 1 and 0 <= by[i].near_next <= 1
    assert by[2].fingerprint == by[201].fingerprint and by[202].fingerprint == by[203].fingerprint


def test_consistent_sampling_estimates_generalised_jaccard():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(30):
        a = words(rng, 300, 80)
        b = " ".join(a.split()[:180] + words(rng, 120, 80).split())
        x, y = (dict(zip(*(v.tolist() for v in fingerprint.weighted_terms(t.encode())))) for t in (a, b))
        true = sum(min(x.get(k, 0), y.get(k, 0)) for k in x | y) / sum(max(x.get(k, 0), y.get(k, 0)) for k in x | y)
        errors.append(fingerprint.likeness(fingerprint.sample_text(a.encode()), fingerprint.sample_text(b.encode())) - true)
    assert abs(np.mean(errors)) < 0.04


@pytest.mark.parametrize("kind", ["words", "no spaces"])
def test_near_copies_across_256_bytes_share_their_terms(kind):
    rng = np.random.default_rng(4)
    for _ in range(30):
        a = words(rng, 90, 80)
        a = a[:a.rindex(" ", 0, 253)] if kind == "words" else "".join(chr(x) for x in rng.integers(0x4E00, 0x5E00, 84))
        b = a + (" another" if kind == "words" else "\u4e8c\u4e09\u56db")
        assert len(a.encode()) <= 256 < len(b.encode())
        x, y = (dict(zip(*(v.tolist() for v in fingerprint.weighted_terms(t.encode())))) for t in (a, b))
        assert sum(min(x.get(k, 0), y.get(k, 0)) for k in x | y) > 0.85 * sum(max(x.get(k, 0), y.get(k, 0)) for k in x | y)
    assert fingerprint.weighted_terms(b" ")[0].size == 0 and fingerprint.weighted_terms("二".encode())[0].size


def test_decontamination_edges(spark):
    docs = frame(spark, [(1, "AAA one-two three 4 five six seven eight nine ten eleven"), (2, "short É item"), (3, None), (3, "Short é item"), (None, "short É item x"), (4, "")])
    bench = spark.createDataFrame([(10, "one two three 4 five six seven eight nine ten eleven twelve"), (11, "short É ITEM"), (11, "short É ITEM"),
                                   (12, None), (None, "aaa"), (13, "...")], "item_id long, text string")
    got = sorted(((r.doc.doc_id, r.n_words, r.n_hit, sorted(r["items"])) for r in decontaminate.contamination(docs, bench).collect()), key=str)
    assert got == sorted([(1, 12, 11, [10]), (2, 3, 3, [11]), (3, 0, 0, []), (3, 3, 0, []), (None, 4, 3, [11]), (4, 0, 0, [])], key=str)
    assert decontaminate.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_differencing_beats_greedy_and_keeps_groups(spark, rows):
    got = sharding.shard_documents(frame(spark, rows), 4).collect()
    assert len(got) == len(rows)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert len({(r.text_crc32, r.shard) for r in got}) == len({r.text_crc32 for r in got})
    sizes = [9, 8, 7, 6, 5]
    placed = sharding.difference([[(w, i)] for i, w in enumerate(sizes)], 2)
    assert abs(sum(w if p else -w for w, p in zip(sizes, placed))) <= 3


def test_hierarchical_differencing(spark, monkeypatch):
    monkeypatch.setattr(sharding, "GROUPS_A_BUCKET", 10)
    monkeypatch.setattr(sharding, "PARTIALS_A_BUCKET", 4)
    groups = spark.range(300).selectExpr("cast(id as string) as key", "id * id % 97 + 8 as total")
    totals = [r.t for r in groups.join(sharding.place_groups(groups, 5), "key").groupBy("shard").agg({"total": "sum"}).toDF("shard", "t").collect()]
    assert len(totals) == 5 and max(totals) - min(totals) <= 105


def test_warc_derivatives(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/x", "<html lang=EN><title>T &amp; t</title><script>var x='</p>'</script><p>One<b>two</b><p>three <a href='/l'>l</a></html>"),
                                   (2, None, None), (2, None, None)], "page_id long, url string, html string")
    made = warc.build_derivatives(pages)
    rows = made.collect()
    assert [(r.page_id, r.kind) for r in rows if r.page_id == 1] == [(1, "metadata"), (1, "conversion")]
    for r in rows:
        head, block = warc.parse(bytes(r.record))
        assert head["WARC-Refers-To"] == r.refers_to and head["WARC-Block-Digest"] == warc.digest(block) == r.block_digest
        if r.page_id == 1:
            assert block.decode() == ("T & t\nOnetwo\nthree l" if r.kind == "conversion" else block.decode())
            assert r.kind == "conversion" or b"outlink: /l" in block and b"language: en" in block
    folder = str(tmp_path / "w")
    os.mkdir(folder)
    back = warc.read_warc(spark, folder, warc.write_warc(made, folder)).collect()
    assert sorted(bytes(r.record) for r in back) == sorted(bytes(r.record) for r in rows)


def test_line_dedup(spark, rows):
    got = {(r.doc_id, r.kept) for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    holders: dict = {}
    for i, t in rows:
        for _, k in line_dedup.line_keys(t, 10):
            if i is not None:
                holders.setdefault(k, set()).add(i)
    want = set()
    for i, t in rows:
        drop = {n for n, k in line_dedup.line_keys(t, 10) if i is not None and len(holders[k]) > 1 and min(holders[k]) != i}
        want.add((i, "\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in drop)))
    assert got == want


def test_levenshtein_automaton_against_brute_force():
    terms = [("idiot", False), ("worthless", False), ("bad", False), ("lowei", True)]
    machine = toxicity.LexiconAutomaton(terms)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = _next(row, i, x, b)
        return row[-1]

    def _next(row, i, x, b):
        out = [i]
        for j, y in enumerate(b, 1):
            out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
        return out

    for w in ("idiot", "idiott", "idot", "iddiot", "idiit", "idxxt", "worthles", "wrthles", "wothes", "bad", "bat", "loweixyz", "lowe", "", "idi"):
        want = [(distance(w, t), i) for i, (t, stem) in enumerate(terms) if not stem and distance(w, t) <= (2 if len(t) >= 9 else 1 if len(t) >= 5 else 0)]
        if w.startswith("lowei"):
            want.append((0, 3))
        hit = machine.match(w)
        assert (hit is None) == (not want), w
        assert hit is None or hit[1] == min(want)[0], w


def test_stems_allow_edits_against_brute_force():
    terms = [("lowei", True), ("réeux", True), ("achlich", True), ("nast", True), ("worthless", False), ("lower", False)]
    machine = toxicity.LexiconAutomaton(terms)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            old, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    def edits(w, t, stem):
        if not stem:
            return distance(w, t)
        return min((distance(w[:k - 1], t[:-1]) + (w[k - 1] != t[-1]) for k in range(1, len(w) + 1)), default=9)

    rng, seen = np.random.default_rng(6), set()
    for _ in range(4000):
        t, stem = terms[rng.integers(0, len(terms))]
        w = list(t + ("ung" if stem and rng.integers(0, 2) else ""))
        for _ in range(rng.integers(0, 3)):
            at = int(rng.integers(0, len(w)))
            w[at:at + int(rng.integers(0, 2))] = list(rng.choice(["", "e", "x", "h"], 1))
        w = "".join(w)
        want = [e for t, stem in terms if (e := edits(w, t, stem)) <= (2 if len(t) >= 9 else 1 if len(t) >= 5 else 0)]
        hit = machine.match(w)
        assert (None if hit is None else hit[1]) == (min(want) if want else None), w
        seen.add(None if hit is None else (terms[hit[0]][1], hit[1]))
    assert {(True, 0), (True, 1), (False, 0), (False, 2), None} <= seen
    assert machine.match("rexeuxement") is None and machine.match("rébeuxement") == (1, 1) and machine.match("achlchkeit") == (2, 1)


def test_toxicity_held_out_and_quotation(spark):
    rng = np.random.default_rng(2)
    rows, marks = [], []
    for i in range(400):
        toxic = i % 4 == 0
        w = words(rng, 40).split()
        for _ in range(3 if toxic else 0):
            w[rng.integers(0, 40)] = "nitwit"
        rows.append((i, " ".join(w)))
        marks.append((i, int(toxic)))
    docs, labels = frame(spark, rows + [(900, None), (901, "")]), spark.createDataFrame(marks + [(5000, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels.where("doc_id % 5 != 0"))
    score = {r.row.doc_id: r.score for r in toxicity.score_texts(docs, model).collect()}
    assert all((score[i] >= 0.5) == bool(t) for i, t in marks) and score[900] == score[901] < 0.5
    scorer = toxicity.Scorer([("nitwit", False, 5.0)])
    assert scorer.features('he said the word "nitwit" is old')[0] < scorer.features("you nitwit!")[0]


def test_token_files_round_trip(spark, rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.byte_bpe_path())
    rows = rows + [(300, "it's <|endoftext|> naïve  œuvre x \x1c y²\n\n z ١٢"), (301, "  lead and trail  ")]
    got = token_files.token_documents(frame(spark, rows), queries.byte_bpe_path()).orderBy("start").collect()
    at = 0
    want = sorted(((-1 if i is None else i), x or "") for i, x in rows)
    for r, (i, x) in zip(got, want):
        ids = np.array(t.encode(x, add_special_tokens=False).ids + [2], "<u4")
        assert ((-1 if r.doc_id is None else r.doc_id), r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(got) == len(want)


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 31, 32])
def test_bit_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 10_001).astype(np.uint32)
    f = token_files.TokenFile(token_files.encode_file([5, None], [4000, 10_001], ids, bits))
    assert (f.ids(0, 10_001) == ids).all() and (f.ids(4090, 8200) == ids[4090:8200]).all() and len(f.ids(3, 3)) == 0


def test_url_filter(spark):
    pages = spark.createDataFrame([(1, "http://A.Example.org/es/1"), (2, "https://x.com/FREE-bet"), (3, None), (4, "no scheme/xxx"), (5, "http://freebet.com/"),
                                   (6, "http://b.example.org/x?casino=1"), (7, "http://de.com/de/x"), (8, "http://notexample.net/casino")], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages).collect()}
    assert got == {1: ("a.example.org", "/es/1", "example.org/es/", "block"), 2: ("x.com", "/FREE-bet", None, "block"), 3: ("", "", None, "allow"),
                   4: ("", "", None, "block"), 5: ("freebet.com", "/", None, "allow"), 6: ("b.example.org", "/x", "org/", "allow"),
                   7: ("de.com", "/de/x", "com/de/", "block"), 8: ("notexample.net", "/casino", None, "block")}


def test_url_filter_rejects_by_soft_terms_alone(spark):
    urls = ["http://free-bets.net/", "http://cheap-pills.net/a", "http://m.ads-track.net/", "http://a.net/spam/backlinks?x", "http://b.net/online-pharmacy/discounts",
            "http://cheap.net/", "http://a.net/pharmacy-history", "http://cheap.net/cheap", "http://adsorb.net/trackside-spammy"]
    assert len(set(url_filter.SOFT_TERMS)) == len(url_filter.SOFT_TERMS) and not set(url_filter.SOFT_TERMS) & set(url_filter.STRICT_TERMS)
    assert all(t.isascii() and t.isalnum() and t == t.lower() for t in url_filter.STRICT_TERMS + url_filter.SOFT_TERMS)
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict, r.strict_hits) for r in url_filter.filter_urls(pages).collect()}
    assert got == {i: (None, "block" if i < 5 else "allow", 0) for i in range(len(urls))}


def test_mixing_meets_targets(spark):
    rng = np.random.default_rng(3)
    rows = [(i, words(rng, 30) if i % 3 else "!!@@ ##$$ " * 20) for i in range(300)] + [(998, None), (999, "")]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)], "doc_id long, quality int")
    docs = frame(spark, rows)
    got = mixing.mix(docs, mixing.train_domains(docs, labels), (0.1, 0.9)).collect()
    p, t, x = np.array([r.p for r in got]), np.array([r.tokens for r in got]), np.array([r.rate for r in got])
    assert (x >= 0).all() and np.allclose((x * t) @ p, np.array([0.1, 0.9]) * t.sum(), rtol=1e-4)


def test_only_texts_go_to_python(spark):
    """Rows stay in Spark while their texts are scored, each once, and a filter on the result does not score them again."""
    docs = frame(spark, [(i, "some words here " * (i % 5)) for i in range(40)]).repartition(40)
    model = {"mean": np.zeros(mixing.TEXT_FEATURES), "scale": np.ones(mixing.TEXT_FEATURES), "w": np.zeros((mixing.TEXT_FEATURES + 1, 2))}
    score = {"lexicon": [], "model": {"mean": np.zeros(toxicity.Scorer.N), "scale": np.ones(toxicity.Scorer.N), "w": np.zeros((toxicity.Scorer.N + 1, 2))}}
    for df in (mixing.mix(docs, model).where("rate >= 0"), toxicity.score_texts(docs, score).where("score < 0.9")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in plan and plan.count("ArrowEvalPython") == 1
        assert df.count() == 40
        assert df.select("row.*").exceptAll(docs).isEmpty()


def test_mixing_rounds_read_a_partition_a_core(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(mixing, "fit_rates", lambda weights, *a: seen.append(weights.rdd.getNumPartitions()) or [])
    mixing.mix(frame(spark, [(i, "a b") for i in range(64)]).repartition(64),
               {"mean": np.zeros(mixing.TEXT_FEATURES), "scale": np.ones(mixing.TEXT_FEATURES), "w": np.zeros((mixing.TEXT_FEATURES + 1, 2))})
    assert seen == [spark.sparkContext.defaultParallelism]


@pytest.mark.parametrize("name", sorted(n for n in queries.registry() if n not in ("op5_warc_derivatives", "op9_url_filter")))
def test_empty_tables(spark, tmp_path, name):
    folder = str(tmp_path)
    for table, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("benchmark", "item_id long, text string"),
                          ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{table}.parquet")
    assert queries.registry()[name](spark, folder).collect() == []


def test_warc_query_reads_what_it_wrote(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"<p>page {i}<a href=x{i}>y</a>") for i in range(40)] + [(None, None, None), (3, "", "")],
                                  "page_id long, url string, html string")
    folder = str(tmp_path / "responses")
    stored = warc.read_warc(spark, folder, warc.write_warc(warc.response_records(pages), folder))
    got = sorted(map(str, warc.derive_records(stored).collect()))
    assert got == sorted(map(str, warc.build_derivatives(pages).collect())) and len(got) == 84
    assert warc.derive_records(warc.response_records(pages.limit(0))).count() == 0


def test_warc_keeps_every_header_of_a_response():
    head = [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Target-URI", "http://a/"), ("WARC-Date", warc.DATE)]
    raw = warc.serialize(head, b"HTTP/1.1 404 Not Found\r\nX-Empty:\r\nX-Tight:v:1\r\nX-Folded: a\r\n  b\r\nSet-Cookie: 1\r\nSet-Cookie: 2\r\n\r\n<p>gone")
    raw = raw.replace(b"WARC-Date: ", b"WARC-Date:").replace(b"WARC/1.1\r\n", b"WARC/1.1\r\nX-None:\r\n")
    fields, block = warc.parse(raw)
    assert fields["X-None"] == "" and fields["WARC-Date"] == warc.DATE
    meta = warc.parse(warc.derive(fields, block)[0][3])[1].decode().split("\r\n")
    assert meta[:8] == ["source-X-Empty: ", "source-X-Tight: v:1", "source-X-Folded: a b", "source-Set-Cookie: 1", "source-Set-Cookie: 2",
                        "source-status: HTTP/1.1 404 Not Found", "source-payload-digest: " + warc.digest(b"<p>gone")] + meta[7:8]


@pytest.mark.parametrize("piece", ['<a "', "<title>", "<title", "<html ", "<a ", "<a href=", "<p '\"", "<!--", "<script>", "</script ", "<a href='", "<"])
def test_warc_hostile_pages_take_linear_time(piece):
    import time
    page = piece * (1_000_000 // len(piece))
    t = time.process_time()
    warc.plain_text(page), warc.title_of(page), warc.language_of(page), warc.links_of(page)
    assert time.process_time() - t < 20


def test_warc_text_title_links():
    page = ("<HTML\nlang='fr'><title>a > b &amp; c</title><a title='x>y' href=\"u v\">one</a> 1 < 2 <br/>two<a name=q>"
            "<A HREF=z>three</A><b class='<p>'>bold</b> <a href='open")
    assert warc.title_of(page) == "a > b & c" and warc.language_of(page) == "fr"
    assert warc.plain_text(page) == "a > b & c\none 1 < 2\ntwothreebold <a href='open"
    assert warc.links_of(page)[-2:] == ["z", "'open"]
    assert warc.title_of("<title>never closed") is None and warc.plain_text("") == ""


def test_quotations_are_pairs_of_marks():
    scorer = toxicity.Scorer([("nitwit", False, 3.0)])
    abuse = scorer.features("you are a nitwit, do not argue")
    assert scorer.features("you're a nitwit, don't argue")[1] == abuse[1] == 0 and scorer.features("you're a nitwit, don't argue")[0] > 0
    for quoted in ('it was "nitwit" there', "it was 'nitwit' there", "it was „nitwit“ there", "it was «nitwit» there", "it was ‘a nitwit’s’ there"):
        assert scorer.features(quoted)[1] > 0, quoted
    for plain in ("dogs' nitwit cats'", 'a "b" nitwit "c" d', 'an open " nitwit here', '"opened\nnitwit" closed'):
        assert scorer.features(plain)[1] == 0, plain


def test_rows_with_one_doc_id_keep_their_own_lines(spark):
    got = sorted((r.doc_id, r.kept, r.n_dropped) for r in line_dedup.dedup_lines(frame(spark, [
        (1, "a line that repeats\nx"), (2, "a line that repeats\ny"), (2, "unique long line of row b\ntail")])).collect())
    assert got == [(1, "a line that repeats\nx", 0), (2, "unique long line of row b\ntail", 0), (2, "y", 1)]


@pytest.mark.parametrize("cache", [token_files.CACHE_UNITS, 50])
def test_encoder_equals_the_library(rows, monkeypatch, cache):
    from tokenizers import Tokenizer
    monkeypatch.setattr(token_files, "CACHE_UNITS", cache)                  # 50: forgets and learns anew all the time
    path = queries.byte_bpe_path()
    t, coder = Tokenizer.from_file(path), token_files.Encoder(path)
    rng = np.random.default_rng(3)
    signs = list("aZ é'stmrvl09 \n\t  .,;!-\x1c²١ñ漢😀͸") + ["<|endoftext|>", "'ll", "  ", "x" * 90, " " * 70]
    texts = [x or "" for _, x in rows] + ["".join(rng.choice(signs, rng.integers(0, 60))) for _ in range(2_000)] + [""]
    for lo in range(0, len(texts), 97):
        some = texts[lo:lo + 97]
        raw = [x.encode() for x in some]
        off = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
        got = coder.encode(off, np.frombuffer(b"".join(raw), np.uint8))
        assert [g.tolist() for g in got] == [t.encode(x, add_special_tokens=False).ids for x in some]
    assert len(coder.known) <= cache or cache == 50


def test_encoder_gives_other_vocabularies_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    t, coder = Tokenizer.from_file(path), token_files.Encoder(path)
    texts = ["It's one  Two\nthree", "", "naïve x2 ²"]
    raw = [x.encode() for x in texts]
    off = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    got = coder.encode(off, np.frombuffer(b"".join(raw), np.uint8))
    assert not coder.by_pieces and [g.tolist() for g in got] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_url_filter_counts_roots_by_weight(spark):
    urls = {"http://a.net/downloads/download.html": ("allow", 1, 1), "http://a.net/ad/ads.html": ("allow", 1, 2), "http://a.net/deals/deal/1": ("allow", 1, 1),
            "http://bank.net/loans/cash": ("allow", 2, 2), "http://a.net/cash-bonus/prize": ("block", 3, 3), "http://a.net/betting/bets-free": ("block", 2, 3),
            "http://a.net/" + "bet-" * 30_000: ("allow", 1, 2), "": ("allow", 0, 0)}
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, hits int")
    got = [(r.verdict, r.soft_hits, r.soft_weight) for r in url_filter.filter_urls(pages).orderBy("page_id").collect()]
    assert got == list(urls.values())
    assert url_filter.filter_urls(pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        url_filter.filter_urls(pages, soft=((1, ("a", "b")), (2, ("b",))))


def test_ngram_members_are_unpacked_by_ranges(rows, monkeypatch):
    """A bucket is never unpacked whole: its members are the same whatever the size of a range, and a range holds a part of them."""
    import pyarrow as pa
    docs = pa.RecordBatch.from_pydict({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows], pa.string())})
    dealt = list(ngram_join._emit(1, 80, 5)([docs]))

    def members():
        out, most = {}, 0
        for batch in ngram_join._members(iter(dealt)):
            most = max(most, len(batch))
            for r in batch.to_pylist():
                key = (r["gid"], r["cls"], r["sid"], r["need"])
                out[key] = out.get(key, 0) + r["weight"]
        return out, most
    whole, largest = members()
    monkeypatch.setattr(ngram_join, "MEMBER_BYTES", 2_000)
    parts, part = members()
    assert parts == whole and whole and part < largest

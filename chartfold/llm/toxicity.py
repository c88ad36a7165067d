"""Toxicity scores from a learned lexicon, matched by Levenshtein automata over a trie.

Learning: words and word starts that are far more frequent in texts labelled toxic become lexicon terms (exact words, or
stems that stand for every word that begins with them).  Matching: the trie of the lexicon and the
Levenshtein automata of its words are one deterministic automaton, built as it is walked; a term of five letters or more, word or
stem, is also found with one edit, one of nine or more with two.  Every hit is weighed by its context window: quotation marks and
reporting words around it speak for a quotation, words for "you" and exclamation marks for abuse.  A
logistic model on the weighed hits gives the score.  Only a pair of marks around the hit is a quotation; apostrophes inside words are none.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable
from .linear import fit, posteriors

TRAIN_ROWS = 20_000            # labelled rows that the model is fitted on, about, at most
LEXICON_TERMS = 2_000          # terms at most
CANDIDATES = 50_000            # words and stems looked up in clean texts, at most
STEM_LENGTHS = (4, 5, 6, 7, 8)
LEAST_LOG_ODDS = 2.5
LEAST_EVIDENCE = 14.0          # log likelihood ratio against the share of toxic texts: about one chance term in a million
WINDOW = 6
STATES = 60_000                # automaton states, and words, remembered; both are built anew beyond

WORD = re.compile(r"[^\W\d_]+")
CLOSES = {'"': '"', "'": "'", "`": "'`", "“": "”", "„": "“”", "«": "»", "»": "«", "‘": "’"}
OPENS, ENDS = "".join(CLOSES), "\"'`“”«»’"
# Marks that may open stand before a character and not after one, marks that may close the other way round: an apostrophe between letters does neither.
QUOTE = re.compile(rf"(?P<line>\n)|(?<![^\s(\[{{—–-])(?P<open>[{OPENS}])(?=\S)|(?<=\S)(?P<close>[{ENDS}])(?![^\W_])")
REPORTING = frozenset("said says say called calls quote quoted quotes word words term terms means meaning wrote writes "
                      "dit disait mot terme sagte sagt wort heißt dijo dice palabra".split())
ADDRESS = frozenset("you your yours youre u ur tu vous toi te ton du dich dein ihr euch usted ustedes vos ti".split())


def allowance(term: str) -> int:
    """Edits with which a term is still found."""
    return 2 if len(term) >= 9 else 1 if len(term) >= 5 else 0


def quoted_spans(text: str) -> list[tuple[int, int]]:
    """Stretches between a quotation mark and the mark that closes it, in one line of the text; a mark without a partner opens nothing."""
    spans, at, ends = [], None, ""
    for m in QUOTE.finditer(text):
        mark = m.group()
        if m.lastgroup == "line":
            at = None
        elif at is not None and m.lastgroup == "close" and mark in ends:
            spans.append((at, m.start()))
            at = None
        elif m.lastgroup == "open" and at is None:
            at, ends = m.end(), CLOSES[mark]
    return spans


class LexiconAutomaton:
    """Trie of the lexicon times the Levenshtein automata of its terms, determinised on demand.

    A state is a set of (trie node, edits so far); a stem accepts any continuation once it is read up to its last letter,
    right or wrong: a word that ends before that letter is no form of the stem.
    """

    def __init__(self, terms: list[tuple[str, bool]]):
        self.terms = terms
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[int | None] = [None]
        self.most: list[int] = [0]                   # edits that some term below allows
        self.free: list[int] = [-1]                  # edits with which the stem that ends here is found
        for i, (term, stem) in enumerate(terms):
            node, allowed = 0, allowance(term)
            self.most[0] = max(self.most[0], allowed)
            for ch in term:
                if ch not in self.next[node]:
                    self.next[node][ch] = len(self.next)
                    self.next.append({})
                    self.ends.append(None)
                    self.most.append(0)
                    self.free.append(-1)
                node = self.next[node][ch]
                self.most[node] = max(self.most[node], allowed)
            if self.ends[node] is None:
                self.ends[node] = i
                self.free[node] = allowed if stem else -1
        self.reset()

    def reset(self):
        self.ids: dict[tuple, int] = {}
        self.sets, self.steps = [], []
        self.stems, self.words = [], []               # what a state accepts: (term, edits) or None
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        # before letters are left out: a stem's last letter has been read
        e, node = min(((e, node) for node, e in nodes.items() if e <= self.free[node]), default=(0, None))
        stem = None if node is None else (self.ends[node], e)
        todo = list(nodes.items())
        while todo:                                   # a letter of the term left out
            node, e = todo.pop()
            if e < self.most[node]:
                for child in self.next[node].values():
                    if e + 1 <= self.most[child] and nodes.get(child, 9) > e + 1:
                        nodes[child] = e + 1
                        todo.append((child, e + 1))
        pairs = tuple(sorted(node << 2 | e for node, e in nodes.items()))
        key = (pairs, stem)
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(pairs)
            self.steps.append({})
            word = None
            for pair in pairs:
                i, e = self.ends[pair >> 2], pair & 3
                if i is not None and not self.terms[i][1] and e <= allowance(self.terms[i][0]) and (word is None or e < word[1]):
                    word = (i, e)
            self.stems.append(stem)
            self.words.append(word)
        return self.ids[key]

    def _step(self, state: int, ch: str) -> int:
        out: dict[int, int] = {}

        def put(node, e):
            if e <= self.most[node] and out.get(node, 9) > e:
                out[node] = e

        for pair in self.sets[state]:
            node, e = pair >> 2, pair & 3
            if e < self.most[node]:
                for c, child in self.next[node].items():
                    put(child, e + (c != ch))         # equal letter or another one
                put(node, e + 1)                      # a letter too many
            elif ch in self.next[node]:
                put(self.next[node][ch], e)
        to = self._state(out) if out else -1
        self.steps[state][ch] = to
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the nearest term, or None; of equally near ones the first of the trie."""
        if len(self.sets) > STATES:
            self.reset()
        state, stem, steps, stems = self.start, None, self.steps, self.stems
        for ch in word:
            to = steps[state].get(ch)
            if to is None:
                to = self._step(state, ch)
            if to < 0:
                return stem
            state = to
            found = stems[state]
            if found is not None and (stem is None or found[1] < stem[1]):
                stem = found
                if not stem[1]:
                    return stem
        best = self.words[state]
        return best if stem is None or (best is not None and best[1] < stem[1]) else stem


class Scorer:
    """Features of a text: weighed exact hits as abuse and as quotation, weighed misspelt hits, their density."""

    N = 5

    def __init__(self, lexicon: list[tuple[str, bool, float]]):
        self.weights = [w for _, _, w in lexicon]
        self.automaton = LexiconAutomaton([(t, s) for t, s, _ in lexicon])
        self.known: dict[str, tuple[int, int] | None] = {}

    def _match(self, word: str):
        if len(self.known) > STATES:
            self.known.clear()
        hit = self.known[word] = self.automaton.match(word)
        return hit

    def features(self, text: str) -> list[float]:
        low = text.lower()
        words = WORD.findall(low)
        known, hits = self.known, {}
        for w in set(words):
            hit = known[w] if w in known else self._match(w)
            if hit is not None:
                hits[w] = hit
        if not hits:
            return [0.0] * self.N
        spans = [m.span() for m in WORD.finditer(low)]
        said = quoted_spans(low)
        said_from = [s for s, _ in said]
        abuse = quoted = fuzzy = count = 0.0
        for i, w in enumerate(words):
            if w not in hits:
                continue
            term, edits = hits[w]
            lo, hi = max(0, i - WINDOW), min(len(words), i + WINDOW + 1)
            right = low[spans[i][1]:spans[hi - 1][1] + 1]
            near = words[lo:i] + words[i + 1:hi]
            k = bisect_right(said_from, spans[i][0]) - 1
            marks = k >= 0 and spans[i][1] <= said[k][1]
            quote = 0.5 * marks + 0.3 * any(x in REPORTING for x in near)
            attack = 0.3 * any(x in ADDRESS for x in near) + 0.2 * ("!" in right)
            value = self.weights[term] * max(0.1, 1 - quote + attack)
            if edits:
                fuzzy += value / (1 + edits)
            elif quote > attack:
                quoted += value
            else:
                abuse += value
            count += not edits
        return [np.log1p(abuse), np.log1p(quoted), np.log1p(fuzzy), min(1.0, abuse), np.log1p(1000 * count / len(words))]


def _term_counts(stems_too: bool, candidates: frozenset | None):
    """Map side: (term, stem, n) document counts, summed within the task."""
    def run(batches):
        words_n, stems_n = Counter(), Counter()
        for batch in batches:
            for text in batch.column("text"):
                words = set(WORD.findall((text.as_py() or "").lower()))
                stems = {w[:k] for w in words for k in STEM_LENGTHS if len(w) >= k} if stems_too else set()
                if candidates is not None:
                    words, stems = {w for w in words if (w, False) in candidates}, {s for s in stems if (s, True) in candidates}
                words_n.update(words)
                stems_n.update(stems)
        out = [(t, False, n) for t, n in words_n.items()] + [(t, True, n) for t, n in stems_n.items()]
        for lo in range(0, len(out), 50_000):
            part = out[lo:lo + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in part], pa.string()), pa.array([x[1] for x in part], pa.bool_()),
                                              pa.array([x[2] for x in part], pa.int64())], names=["term", "stem", "n"])
    return run


def choose_terms(toxic: dict, clean: dict, n_toxic: int, n_clean: int) -> list[tuple[str, bool, float]]:
    """Lexicon (term, is stem, log odds).  ``toxic``, ``clean``: document counts by (term, is stem).

    A stem is taken as long as its support lasts; where one word makes up most of it, the word is the term.
    """
    base = n_toxic / max(1, n_toxic + n_clean)

    def odds(key):
        a, b = toxic.get(key, 0), clean.get(key, 0)
        evidence = sum(n * np.log(n / (a + b) / share) for n, share in ((a, base), (b, 1 - base)) if n and share)
        if evidence < LEAST_EVIDENCE:
            return 0.0
        return np.log((a + 0.5) / (n_toxic + 1)) - np.log((b + 0.5) / (n_clean + 1))

    children: dict[str, list[str]] = {}
    for t, stem in toxic:
        if stem and len(t) > STEM_LENGTHS[0]:
            children.setdefault(t[:-1], []).append(t)
    top: dict[str, tuple[str, int]] = {}              # most frequent word under a stem
    for (t, stem), n in toxic.items():
        if not stem:
            for k in STEM_LENGTHS:
                if len(t) >= k and top.get(t[:k], ("", 0))[1] < n:
                    top[t[:k]] = (t, n)
    out = [(t, False, odds((t, False))) for t, stem in toxic if not stem and len(t) < STEM_LENGTHS[0] and odds((t, False)) >= LEAST_LOG_ODDS]
    todo = sorted(t for t, stem in toxic if stem and len(t) == STEM_LENGTHS[0])
    while todo:
        stem = todo.pop()
        below = sorted(children.get(stem, []))
        word, n = top.get(stem, ("", 0))
        if odds((stem, True)) < LEAST_LOG_ODDS:
            todo += below
            if not below and word and odds((word, False)) >= LEAST_LOG_ODDS:
                out.append((word, False, odds((word, False))))
            continue
        if n >= 0.8 * toxic[(stem, True)]:
            out.append((word, False, odds((word, False))))
            continue
        longer = [c for c in below if toxic[(c, True)] >= 0.9 * toxic[(stem, True)]]
        if longer:
            todo.append(longer[0])
        else:
            out.append((stem, True, odds((stem, True))))
    out = [(t, s, float(w)) for t, s, w in out if w >= LEAST_LOG_ODDS]
    return sorted(set(out), key=lambda x: (-x[2], x[0]))[:LEXICON_TERMS]


def _features(lexicon, label: bool):
    def run(batches):
        scorer = Scorer(lexicon)
        for batch in batches:
            rows = [scorer.features(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column("y")], names=["x", "y"])
    return run


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict:
    """Lexicon and model from labelled texts (``labels``: doc_id, toxic 0/1; nulls are left out, of repeated labels the greatest counts).

    Above ``rows`` labelled rows a share of them is taken by a hash of doc_id.  The driver holds the lexicon, and five features for each sampled row.
    """
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y"))
              .where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y")))
    total = marked.count()
    if total > rows:
        marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * rows / total))
    texts = durable(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                    .join(F.broadcast(marked), "doc_id").groupBy(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
                    .agg(F.first("text").alias("text"), F.max("y").alias("y")).select("text", "y"))   # copies of a text teach once
    sizes = {r.y: r.n for r in texts.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    kind = "term string, stem boolean, n long"
    support = max(4, n_toxic // 250)
    toxic = {(r.term, r.stem): r.n for r in texts.where("y = 1").mapInArrow(_term_counts(True, None), kind).groupBy("term", "stem")
             .agg(F.sum("n").alias("n")).where(F.col("n") >= support).orderBy(F.desc("n"), "term").limit(CANDIDATES).collect()}
    clean = {(r.term, r.stem): r.n for r in texts.where("y = 0").mapInArrow(_term_counts(True, frozenset(toxic)), kind)
             .groupBy("term", "stem").agg(F.sum("n").alias("n")).collect()}
    lexicon = choose_terms(toxic, clean, n_toxic, n_clean)
    made = texts.select("text", "y").mapInArrow(_features(lexicon, True), "x array<double>, y int").collect()
    x = np.array([r.x for r in made], float).reshape(-1, Scorer.N)
    return {"lexicon": lexicon, "model": fit(x, np.array([r.y for r in made], int), 2)}


def _score(model: dict):
    """Score of a text.  Only texts go to Python; not deterministic to Spark, so that a filter on the score does not run it again."""
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model["lexicon"])
        for texts in batches:
            x = np.array([scorer.features(t.as_py() or "") for t in texts], float).reshape(-1, Scorer.N)
            yield pa.array(posteriors(model["model"], x)[:, 1] if len(x) else np.empty(0), pa.float64())
    return score.asNondeterministic()


def score_texts(docs: DataFrame, model: dict) -> DataFrame:
    """(row, score): every row of ``docs`` as the struct ``row`` with its toxicity, 0 to 1.

    Null and empty texts have no hit and the score of such texts.  Rows are independent of each other; extra columns
    stay inside ``row``.  Long texts are read whole.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(whole, _score(model)(F.col("text").cast("string")).alias("score"))


def held_out(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0

"""Toxicity scores from a learned lexicon, matched by Levenshtein automata.

1. Lexicon: words and word beginnings (four letters or more, marked `*`) that labelled toxic
   documents hold significantly more than LEAST_ODDS times as often as other labelled documents
   (likelihood ratio). All labelled training rows are counted; a use between quotation marks
   does not count on either side. The least count is the same at every size.
2. Matching: the lexicon is a trie. Its product with the automaton of one edit is made
   deterministic once, and all words of a slice of texts run through that table together: exact
   terms and beginnings, and misspellings (one insertion, deletion or substitution) of
   whole words of five letters or more. Two words with a single digit or symbol between them
   are also read as one, in which that is a wrong letter or a letter too many.
3. Context: a hit counts 1, less a half for a quotation mark in the three words before it and
   a half for one in the three words after it; what is taken off counts as quotation.
4. Score: logistic regression of the logarithms of those sums, fitted on at most FIT_ROWS
   labelled training rows (those with the smallest hashes of their ids).

Only the text decides a score. Defined results: null and empty texts have no hits and the score of
a text without hits; null labels and ids are not learned from; a null id has no remainder, so
its `held_out` is null, and its text is scored as any other; a document with several labels
is toxic if one says so; repeated documents are scored each; without labels every score is
0; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from roadlake.llm.tables import sieve, stored
from roadlake.llm.textbytes import slices

FIT_ROWS = 50_000
LEAST_DOCUMENTS = 4
LEAST_ODDS = 5  # share among toxic documents over share among others
SIGNIFICANT = 5.41  # chi-square of one degree, 1 % on one side
HELD_TERMS = 200_000
STEM = 4
FUZZY = 5
CONTEXT = 3
RIDGE = 1e-2
FEATURES = ("exact", "fuzzy", "quoted", "density")
_QUOTES = "\"“”„‟«»‹›"
_WORD = re.compile(r"[^\W\d_]+")
_QUOTED = re.compile(f"[{_QUOTES}]")
_LETTER = np.array([chr(i).isalpha() for i in range(1 << 16)])
_FOLD = np.array([ord(c) if len(c := chr(i).lower()) == 1 else i for i in range(1 << 16)], np.uint32)
_SPACE = np.array([chr(i).isspace() for i in range(1 << 16)])
_QUOTE = np.zeros(1 << 16, bool)
_QUOTE[[ord(c) for c in _QUOTES]] = True


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def terms_of(text: str | None) -> set[str]:
    """Words, and their beginnings with `*`, but for words with quotation marks on both sides."""
    text = (text or "").lower()
    quotes = [m.start() for m in _QUOTED.finditer(text)]
    if len(quotes) < 2:
        words = set(_WORD.findall(text))
    else:
        spans = [m.span() for m in _WORD.finditer(text)]
        words = set()
        for k, (start, end) in enumerate(spans):
            left, right = spans[max(k - CONTEXT, 0)][0] - 1, spans[min(k + CONTEXT, len(spans) - 1)][1] + 1
            before, after = bisect_left(quotes, start), bisect_left(quotes, end)
            if before == bisect_left(quotes, left) or after == bisect_left(quotes, right):
                words.add(text[start:end])
    return words | {w[:k] + "*" for w in words for k in range(STEM, len(w))}


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter[str], Counter[str]] = Counter(), Counter()

    def counted() -> pa.RecordBatch:
        terms = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array([c[t] for t in terms], pa.int64()) for c in counts]
        return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *columns], names=["term", "clean", "toxic"])

    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            if toxic in (0, 1):
                counts[toxic].update(terms_of(text))
            if len(counts[0]) + len(counts[1]) > HELD_TERMS:
                yield counted()
                for c in counts:
                    c.clear()
    yield counted()


def learn_lexicon(labelled: DataFrame) -> list[str]:
    """Words, and beginnings with `*`, of toxic documents. labelled: text, toxic."""
    sizes = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return []
    counted = labelled.select("text", "toxic").mapInArrow(_count, "term string, clean long, toxic long")
    counted = counted.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # Of the documents with a term, more are toxic than odds of LEAST_ODDS explain.
    usual = LEAST_ODDS * n_toxic / (LEAST_ODDS * n_toxic + n_clean)
    toxic, clean, both = F.col("toxic"), F.col("clean"), F.col("toxic") + F.col("clean")
    ratio = 2 * (toxic * F.log(toxic / (both * usual)) + F.when(clean > 0, clean * F.log(clean / (both * (1 - usual)))).otherwise(0.0))
    found = counted.where(toxic >= LEAST_DOCUMENTS).where((toxic > both * usual) & (ratio >= SIGNIFICANT)).collect()
    odds = {r.term: r.toxic / (r.clean + 0.5) for r in found}
    best: dict[str, float] = {}
    for t, o in odds.items():
        for k in range(STEM, len(t) if t.endswith("*") else len(t) + 1):
            best[t[:k]] = max(best.get(t[:k], 0.0), o)
    # A beginning stands for all that begin with it, unless other words blur what its terms tell.
    kept: set[str] = set()
    for s in sorted((t[:-1] for t in odds if t.endswith("*")), key=len):
        if 2 * odds[s + "*"] >= best[s] and not any(s[:k] in kept for k in range(STEM, len(s))):
            kept.add(s)
    words = [t for t in odds if not t.endswith("*")]  # all of them, for matching with an edit
    return sorted(words) + sorted(s + "*" for s in kept)


class Automaton:
    """A table that reads words letter by letter: 2 for a term, 1 for a term with one edit."""

    def __init__(self, lexicon: list[str]):
        letters = sorted({c for t in lexicon for c in t.rstrip("*")})
        self.letter_class = np.zeros(1 << 16, np.int32)  # 0: any other letter
        for k, c in enumerate(letters):
            if ord(c) < 1 << 16:
                self.letter_class[ord(c)] = k + 1
        trie: list[dict[str, int]] = [{}]
        ends: list[str] = [""]  # w: a word, s: a beginning, f: a word that may be misspelled
        for term in lexicon:
            node = 0
            for c in term.rstrip("*"):
                if c not in trie[node]:
                    trie[node][c] = len(trie)
                    trie.append({})
                    ends.append("")
                node = trie[node][c]
            ends[node] += "s" if term.endswith("*") else "wf" if len(term) >= FUZZY else "w"
        # Below a node: is there any word that may be misspelled?
        fuzzy = ["f" in e for e in ends]
        for node in range(len(trie) - 1, -1, -1):
            fuzzy[node] |= any(fuzzy[child] for child in trie[node].values())

        def close(states: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
            """Adds the nodes that a left-out letter reaches."""
            missing = {(child, 1) for node, edits in states if edits == 0 for child in trie[node].values() if fuzzy[child]}
            return frozenset(states | missing)

        def read(states: frozenset[tuple[int, int]], letter: str) -> frozenset[tuple[int, int]]:
            after: set[tuple[int, int]] = set()
            for node, edits in states:
                child = trie[node].get(letter)
                if child is not None and (edits == 0 or fuzzy[child]):
                    if edits == 0 and "s" in ends[child]:
                        return frozenset({(-1, 0)})
                    after.add((child, edits))
                if edits == 0 and node >= 0 and fuzzy[node]:
                    after.add((node, 1))  # a letter too many
                    after.update((c, 1) for c in trie[node].values() if fuzzy[c])  # a wrong letter
            return close(after)

        start, found = close({(0, 0)}), frozenset({(-1, 0)})
        number, todo, rows = {start: 0}, [start], []
        while todo:
            states = todo.pop(0)
            row = []
            for letter in ["\0", *letters]:
                after = found if states == found else read(states, letter)
                if after not in number:
                    number[after] = len(number)
                    todo.append(after)
                row.append(number[after])
            rows.append(row)
        self.table = np.array(rows, np.int32)
        self.verdict = np.zeros(len(number), np.int8)
        for states, k in number.items():
            if states == found or any(e == 0 and "w" in ends[n] for n, e in states if n >= 0):
                self.verdict[k] = 2
            elif any(e == 1 and "f" in ends[n] for n, e in states):
                self.verdict[k] = 1
        # States that no letter leaves.
        self.stuck = (self.table == np.arange(len(number))[:, None]).all(axis=1)

    def read_words(self, letters: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        classes = self.letter_class[letters]
        state = np.zeros(len(starts), np.int32)
        live, at = np.arange(len(starts)), 0
        while len(live):
            state[live] = self.table[state[live], classes[starts[live] + at]]
            at += 1
            live = live[(lengths[live] > at) & ~self.stuck[state[live]]]
        return self.verdict[state]


def _features_of(texts: pa.Array, automaton: Automaton) -> np.ndarray:
    parts = []
    for s in slices(texts):
        points = np.frombuffer(s.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        heads = np.concatenate([[0], np.cumsum((s.data & 0xC0) != 0x80)])
        bounds = heads[s.bounds]
        points = np.where(points < 1 << 16, points, 0x4E00)  # beyond the first plane: some letter
        letters = _FOLD[points]
        inside = _LETTER[letters]
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        cuts = bounds[1:-1]
        before[cuts[(cuts > 0) & (cuts < len(inside))]] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        after[cuts[(cuts > 0) & (cuts < len(inside))] - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        counts = np.diff(np.searchsorted(starts, bounds))
        verdict = automaton.read_words(letters, starts, ends - starts)
        # Neighbours that no term is in, with one digit or symbol between them.
        texts_of = np.repeat(np.arange(s.n), counts)
        joint = np.flatnonzero((starts[1:] == ends[:-1] + 1) & (texts_of[1:] == texts_of[:-1]) & (verdict[1:] == 0) & (verdict[:-1] == 0))
        joint = joint[~_SPACE[points[ends[joint]]] & ~_QUOTE[points[ends[joint]]]]
        joint = joint[automaton.read_words(letters, starts[joint], ends[joint + 1] - starts[joint]) > 0]
        verdict[joint] = 1
        tail = np.arange(len(starts))  # the last word of a hit
        tail[joint] += 1
        hit = np.flatnonzero(verdict)
        tail = tail[hit]
        text = texts_of[hit]
        first = (np.cumsum(counts) - counts)[text]
        last = first + counts[text] - 1
        quotes = np.concatenate([[0], np.cumsum(_QUOTE[points])])
        left = np.maximum(starts[np.maximum(hit - CONTEXT, first)] - 1, bounds[text]) if len(hit) else hit
        right = np.minimum(ends[np.minimum(tail + CONTEXT, last)] + 1, bounds[text + 1]) if len(hit) else hit
        abuse = 1 - 0.5 * (quotes[starts[hit]] > quotes[left]) - 0.5 * (quotes[right] > quotes[ends[tail]])
        total = lambda w: np.bincount(text, weights=w, minlength=s.n)  # noqa: E731,B023
        exact, fuzzy = total(abuse * (verdict[hit] == 2)), total(abuse * (verdict[hit] == 1))
        parts.append(np.stack([
            np.log1p(exact), np.log1p(fuzzy), np.log1p(total(1 - abuse)), np.log1p(100 * (exact + fuzzy) / np.maximum(counts, 1)),
        ], axis=1))
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def with_features(automaton: Automaton):
    def run(texts: pa.Array) -> pa.Array:
        x = _features_of(texts, automaton)
        return pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))

    return arrow_udf(run, T.ArrayType(T.DoubleType()))


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Coefficients, the constant last, by Newton steps with a ridge."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + RIDGE * np.eye(len(w)), x.T @ (y - p) - RIDGE * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, features."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = stored(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    texts = docs.select("doc_id", "text").where(sieve(known, "doc_id")(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0))))
    # The same join at every size: a plan that broadcasts small labels only hides what large ones cost.
    labelled = stored(texts.join(known.hint("shuffle_merge"), "doc_id"), "labelled")
    automaton = Automaton(learn_lexicon(labelled))
    features = with_features(automaton)
    # Features before the sample: texts are not sorted, at any size.
    described = labelled.select(F.xxhash64("doc_id").alias("place"), features("text").alias("x"), "toxic")
    fitted = described.orderBy("place").limit(FIT_ROWS).select("x", "toxic").collect()
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), features("text").alias("features"))
    if not fitted:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), "features")
    w = fit_logistic(np.array([r.x for r in fitted]), np.array([r.toxic for r in fitted], float))
    z = F.lit(float(w[-1]))
    for k in range(len(FEATURES)):
        z = z + F.col("features")[k] * float(w[k])
    rows = rows.withColumn("score", 1 / (1 + F.exp(-z)))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "features")

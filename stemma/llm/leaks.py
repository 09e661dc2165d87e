"""Evaluation passages inside corpus texts, found by latent semantic retrieval.

1. Texts and passages become sequences of term ids over the passages' vocabulary, under a
   fold that letters confused by scanners share.
2. TF-IDF weights come from the document frequencies of all documents, of words outside of
   passage-like pairs.
3. Windows of weighted terms of all documents and passages form a matrix A; its leading
   singular values and right singular vectors come from a distributed randomised SVD: every
   partition adds up its part of A'(A W) for one fixed random W, then, with the orthonormal
   basis Q of their sum, its part of (A Q)'(A Q), whose eigenvectors turn Q.
4. Windows and passage chunks meet by cosine in that space.
5. Each candidate is settled by the longest common subsequence of words, with the gaps
   that missing words, replaced words and foreign cues leave, and by an answer check: its
   words count for the share of weight that those found have of all of the passage between them.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.edits import deletes, undo_encoding, weighted_distance
from stemma.llm.quality import visible_lines
from stemma.sources.tables import cut

#: Words of a passage in sequence that make a case.
LEAST_WORDS = 12
#: Terms of a window and step between windows, in weighted terms.
WINDOW, STEP = 12, 6
#: Rank of the latent space, and the least cosine of a candidate.
RANK, COSINE = 256, 0.38
#: Terms in more than this share of the documents get no weight, unless a run of LEAST_WORDS words of
#: a passage would then have fewer than LEAST_TERMS terms with weight.
COMMON_SHARE, LEAST_TERMS = 0.05, 3
#: Groups into which partial sums of partitions are added up first.
SUMS = 64
#: Passages whose chunks a task holds at once; more are searched in blocks of this size, each
#: over the term ids, not the texts.
BLOCK = 20_000
#: Words of a passage in a row that may be missing; words on either side that make a
#: replaced or added word between them one of the passage's; and the least share of the weight of a
#: stretch of a passage that its found words have.
MISSING, SOLID, ANSWER = 2, 4, 0.6

# --- fixed values: letters that scanners confuse, as one letter each ----------------
_FOLD = str.maketrans({"1": "i", "l": "i", "|": "i", "!": "i", "j": "i", "0": "o", "5": "s", "c": "e", "f": "t", "b": "h", "8": "h", "6": "h", "9": "g", "q": "g", "v": "u", "ß": "s"})
_FOLD_PAIRS = (("rn", "m"), ("nn", "m"), ("uu", "w"), ("ii", "h"), ("ei", "d"))
# -----------------------------------------------------------------------------------
_WORD = re.compile(r"[^\W_]+(?:[|!][^\W_]+)*")


def fold_word(word: str) -> str:
    """A word as scanners may have read it: accents off, confusable letters made one."""
    if not word.isascii():
        word = "".join(c for c in unicodedata.normalize("NFKD", undo_encoding(word)) if not unicodedata.combining(c))
    word = word.lower().translate(_FOLD)
    for a, b in _FOLD_PAIRS:
        word = word.replace(a, b)
    return word


def words_of(text: str | None) -> list[list[str]]:
    """The words of a text's visible lines, line by line; none for a null or empty text."""
    return [w for x in visible_lines(text) if (w := _WORD.findall(x))] if text else []


@dataclass(frozen=True)
class Passages:
    """The passages of a block as term ids; ids number the folded words."""

    item_ids: list
    terms: dict
    sequences: list

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Passages:
        terms: dict[str, int] = {}
        sequences = [np.array([terms.setdefault(fold_word(w), len(terms)) for w in _WORD.findall(p or "")], np.int32) for _, p in rows]
        return cls([i for i, _ in rows], terms, sequences)


class Vocabulary:
    """Term ids of words as typed: by their fold, or by a term up to one edit from it (two
    from 8 letters on), found in a symmetric-delete dictionary of the passages' terms."""

    def __init__(self, terms: dict):
        self.terms, self.known, self.near = terms, {}, {}
        for term, i in terms.items():
            if len(term) >= 5:
                for d in deletes(term, 1 + (len(term) >= 8)):
                    self.near.setdefault(d, []).append((term, i))

    def look_up(self, word: str) -> int:
        folded = fold_word(word)
        found = self.terms.get(folded)
        if found is None and 4 <= len(folded) <= 40 and sum(map(str.isdigit, word)) < len(word) / 2:  # other numbers are other words
            most, best = 1 + (len(folded) >= 8), None
            for d in deletes(folded, most):
                for term, i in self.near.get(d, ()):
                    if abs(len(term) - len(folded)) <= most:
                        cost = weighted_distance(folded, term)
                        if cost <= most and (best is None or (cost, i) < best):
                            best = (cost, i)
            found = best[1] if best else -1
        return -1 if found is None else found

    def ids(self, words: list[str]) -> np.ndarray:
        known = self.known
        try:
            made = [known[w] for w in words]
        except KeyError:
            if len(known) > 400_000:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = self.look_up(w)
            made = [known[w] for w in words]
        return np.array(made, np.int32)


#: Between the term ids of two lines.
LINE_END = -2


_LAST: list = []  # of a worker, which takes many tasks


def _vocabulary(terms: dict) -> Vocabulary:
    """The vocabulary of these terms, with what it has looked up in earlier tasks of the worker."""
    if not _LAST or _LAST[0].terms != terms:
        _LAST[:] = [Vocabulary(terms)]
    return _LAST[0]


def token_rows(documents: DataFrame, terms: dict, key: str, text: str) -> DataFrame:
    """(doc_id, ids binary): of each document its words as term ids (int32), -1 for a word
    of no passage, LINE_END between lines; documents without words have no row."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = _vocabulary(terms)
        for b in batches:
            docs, ids = [], []
            for d, t in zip(b["_key"], b["_text"]):
                if lines := words_of(t):
                    flat = vocabulary.ids([w for words in lines for w in words])
                    docs.append(d)
                    ids.append(np.insert(flat, np.cumsum([len(w) for w in lines[:-1]]).astype(int), LINE_END).astype(np.int32).tobytes())
            yield pd.DataFrame({"doc_id": docs, "ids": ids})

    return documents.where(F.col(key).isNotNull() & (F.length(text) > 0)).select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text")).mapInPandas(work, "doc_id long, ids binary")


def of_bytes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(term ids, line of each) of a document."""
    ids = np.frombuffer(raw, np.int32)
    end = ids == LINE_END
    return ids[~end], np.cumsum(end)[~end]


def document_frequencies(tokens: DataFrame, size: int, codes: np.ndarray) -> tuple[int, np.ndarray]:
    """The number of documents, and of those with each term outside of passage-like word
    pairs: one vector per partition is added up.

    A term counts only where neither neighbour goes on as in a passage (``codes``: the sorted
    codes of the passages' neighbouring words). So the words of a passage that stands in a
    third of all documents keep their weight, and words of common speech lose theirs.
    """

    def work(batches):
        n, total = 0, np.zeros(size, np.int64)
        for b in batches:
            for raw in b["ids"]:
                doc, _ = of_bytes(raw)
                own = step_codes(doc, size)
                at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
                pair = (codes[at] == own) & (own >= 0)
                alone = doc >= 0
                alone[:-1] &= ~pair
                alone[1:] &= ~pair
                total[np.unique(doc[alone])] += 1
                n += 1
        yield pd.DataFrame({"n": [n], "term": [None], "df": [None]})
        at = np.flatnonzero(total)
        yield pd.DataFrame({"n": 0, "term": at, "df": total[at]})

    sums = tokens.mapInPandas(work, "n long, term long, df long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")).collect()
    out = np.zeros(size, np.int64)
    n = 0
    for r in sums:  # as many rows as the passages have terms
        if r.term is None:
            n = r.n
        else:
            out[r.term] = r.df
    return int(n or 0), out


def term_weights(df: np.ndarray, n: int, sequences: list[np.ndarray], least: int) -> np.ndarray:
    """The TF-IDF weight of each term: none for common ones, but at least LEAST_TERMS terms of
    every run of ``least`` words of a passage keep theirs, so no passage is out of reach."""
    full = np.log((n + 1) / (df + 1)) + 1e-3
    weights = np.where(df <= COMMON_SHARE * n, full, 0.0)
    for ids in sequences:
        for lo in range(max(1, len(ids) - least + 1)):
            run = np.unique(ids[lo : lo + least])
            lacking = LEAST_TERMS - int((weights[run] > 0).sum())
            if lacking > 0:
                rest = run[weights[run] == 0]
                kept = rest[np.argsort(-full[rest], kind="stable")[:lacking]]
                weights[kept] = full[kept]
    return weights


def windows(sequences: list[np.ndarray], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sequence of each window; window, term and weight of each entry) of the windows of
    the sequences' weighted terms, windows in order."""
    who, rows, terms, n = [], [], [], 0
    for k, ids in enumerate(sequences):
        ids = ids[ids >= 0]
        own = ids[weights[ids] > 0]
        if len(own):
            starts = np.arange(0, max(1, len(own) - WINDOW + STEP), STEP)
            at = starts[:, None] + np.arange(WINDOW)[None]
            row, col = np.nonzero(at < len(own))
            terms.append(own[at[row, col]])
            rows.append(row + n)
            who.append(np.full(len(starts), k))
            n += len(starts)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.float32)
    term = np.concatenate(terms)
    return np.concatenate(who), np.concatenate(rows), term, weights[term].astype(np.float32)


def dense(row: np.ndarray, term: np.ndarray, weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The windows in the space of ``basis``, some thousands at a time."""
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, np.int64)
    out = np.empty((len(starts), basis.shape[1]), np.float32)
    for lo in range(0, len(starts), 4_096):
        own = starts[lo : lo + 4_096]
        end = starts[lo + 4_096] if lo + 4_096 < len(starts) else len(row)
        at = slice(own[0], end)
        out[lo : lo + 4_096] = np.add.reduceat(basis[term[at]] * weight[at, None], own - own[0], axis=0)
    return out


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


@dataclass(frozen=True)
class LatentSpace:
    """Right singular vectors (terms x rank), singular values, and the share of the squared
    weights of the windows that lies outside of them."""

    basis: np.ndarray
    values: np.ndarray
    residual: float


def latent_space(tokens: DataFrame, passages: Passages, weights: np.ndarray, rank: int = RANK, seed: int = 7) -> LatentSpace:
    """The leading singular values and right singular vectors of the TF-IDF windows of all
    documents and passages, in two passes over the term ids."""
    size = len(weights)
    rank = min(rank, size)
    draw = np.random.default_rng(seed).standard_normal((size, rank)).astype(np.float32)

    def summed(add, shape: tuple[int, int]) -> np.ndarray:
        """The sum of what add(total, sequences) puts into each partition's total."""
        blocks = min(16, shape[0])

        def work(batches):
            total, used = np.zeros(shape, np.float32), False
            for b in batches:
                add(total, [of_bytes(raw)[0] for raw in b["ids"]])
                used = True
            if used:
                yield pd.DataFrame({"block": range(blocks), "part": [x.tobytes() for x in np.array_split(total, blocks)]})

        def join(key, b):
            return pd.DataFrame({"block": [key[0]], "part": [np.sum([np.frombuffer(x, np.float32) for x in b["part"]], axis=0, dtype=np.float64).astype(np.float32).tobytes()]})

        total = np.zeros(shape, np.float32)
        add(total, passages.sequences)
        total = total.astype(np.float64)
        rows = np.array_split(np.arange(shape[0]), blocks)
        # in two steps, so that no task takes a block of every partition
        parts = tokens.mapInPandas(work, "block int, part binary").withColumn("some", F.spark_partition_id() % SUMS)
        parts = parts.groupBy("block", "some").applyInPandas(join, "block int, part binary").groupBy("block").applyInPandas(join, "block int, part binary")
        for r in parts.collect():  # one matrix in blocks
            total[rows[r.block]] += np.frombuffer(r.part, np.float32).reshape(len(rows[r.block]), shape[1])
        return total

    def entries(sequences: list[np.ndarray]):
        _, row, term, w = windows(sequences, weights)
        for lo in range(0, len(row), 50_000):  # by entries, so that little is held at once
            lo = lo and int(np.searchsorted(row, row[lo]))
            hi = len(row) if lo + 50_000 >= len(row) else int(np.searchsorted(row, row[lo + 50_000]))
            if hi > lo:
                yield row[lo:hi], term[lo:hi], w[lo:hi]

    def sketch(total: np.ndarray, sequences: list[np.ndarray]) -> None:
        for r, t, v in entries(sequences):
            y = dense(r, t, v, draw)[np.cumsum(np.r_[False, r[1:] != r[:-1]])]
            order = np.argsort(t, kind="stable")
            t = t[order]
            starts = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
            total[t[starts]] += np.add.reduceat(y[order] * v[order][:, None], starts, axis=0)

    q = np.linalg.qr(summed(sketch, (size, rank)))[0].astype(np.float32)

    def gram(total: np.ndarray, sequences: list[np.ndarray]) -> None:
        for r, t, v in entries(sequences):
            y = dense(r, t, v, q)
            total[:rank] += y.T @ y
            at = (r - r[0]).astype(np.int64) * size + t
            order = np.argsort(at, kind="stable")  # a term may stand twice in a window
            starts = np.flatnonzero(np.r_[True, at[order][1:] != at[order][:-1]])
            total[rank, 0] += float((np.add.reduceat(v[order].astype(np.float64), starts) ** 2).sum())

    both = summed(gram, (rank + 1, rank))
    power, turn = np.linalg.eigh(both[:rank])
    order = np.argsort(-power)
    power = np.maximum(power[order], 0.0)
    kept = power > 1e-9 * max(power.max(initial=0.0), 1e-30)
    whole = both[rank, 0]
    return LatentSpace((q @ turn[:, order[kept]]).astype(np.float32), np.sqrt(power[kept]), float(max(0.0, 1 - power.sum() / whole)) if whole else 0.0)


class Steps:
    """The steps of a passage from a word to the next, or past up to MISSING left out: by
    the code of both terms, the places in the passage."""

    def __init__(self, passage: np.ndarray, size: int, weights: np.ndarray):
        self.places: dict[int, list[tuple[int, int]]] = {}
        terms = passage.tolist()
        for j, t in enumerate(terms):
            for k in range(j + 1, min(j + 2 + MISSING, len(terms))):
                self.places.setdefault(t * size + terms[k], []).append((j, k))
        self.codes = np.array(sorted(self.places) or [-1], np.int64)
        self.weights = weights[passage]
        self.heavy = (self.weights > 0).tolist()


def step_codes(doc: np.ndarray, size: int) -> np.ndarray:
    """The codes of a document's neighbouring words; -1 where one is in no passage."""
    a, b = doc[:-1].astype(np.int64), doc[1:].astype(np.int64)
    return np.where((a >= 0) & (b >= 0), a * size + b, -1)


def stretches(codes: np.ndarray, steps: Steps) -> list[tuple[int, int, int, int, int]]:
    """(doc start, doc end, passage start, passage end, the passage's found places as bits) of the runs of neighbouring words of
    a document that are steps of the passage. Runs without a weighted word are chance."""
    found = np.minimum(np.searchsorted(steps.codes, codes), len(steps.codes) - 1)
    at = np.flatnonzero((steps.codes[found] == codes) & (codes >= 0))
    out, before, last, heavy = [], {}, -2, steps.heavy
    for i, code in zip(at.tolist(), codes[at].tolist()):
        if i != last + 1:
            out += before.values()
            before = {}
        now, taken = {}, set()
        for j, k in steps.places[code]:
            r = before.get(j)
            if r:
                taken.add(j)
                made = (r[0], i + 1, r[2], k, r[4] + 1, r[5] or heavy[k], r[6] | 1 << k)
            else:
                made = (i, i + 1, j, k, 2, heavy[j] or heavy[k], 1 << j | 1 << k)
            if k not in now or made[4] > now[k][4]:
                now[k] = made
        out += [r for k, r in before.items() if k not in taken]
        before, last = now, i
    out += before.values()
    return sorted((*r[:4], r[6]) for r in out if r[5])


def common_run(codes: np.ndarray, line: np.ndarray, steps: Steps, least: int = 1) -> tuple[int, float]:
    """(words, answer): the most words of a passage that stand in sequence in a document, and
    the share that they have of the weight of the passage from the first to the last of them.

    This is a longest common subsequence by stretches of neighbouring words. A stretch goes on
    where the last one ended in the passage, up to MISSING words aside, if what stands
    between in the document is lines of other cues, however many (the one ends its line and the other begins one,
    but for as many words as are missing), or a replaced or added word between stretches of SOLID
    words each. Documents of which all stretches together have fewer than ``least`` words have none.
    codes: of the document's neighbouring words (``step_codes``); line: of each of its words.
    """
    found = stretches(codes, steps)
    if sum(pj - pi + 1 for _, _, pi, pj, _ in found) < least:
        return 0, 0.0
    chain: list[tuple] = []
    by_end: dict[int, list[int]] = {}
    best = -1
    for di, dj, pi, pj, places in found:
        total, before = pj - pi + 1, -1
        for ep in range(pi - MISSING - 1, pi + 2):
            for k in by_end.get(ep, ()):
                ej, ebegin, t = chain[k][1], chain[k][2], chain[k][4]
                gap, between = pi - ep - 1, di - ej - 1
                if between < 0 or pj <= ep:
                    continue
                near = between <= max(gap, 0) + 1 and (between == 0 or min(ep - ebegin, pj - pi) + 1 >= SOLID)
                if not near and line[di] > line[ej]:
                    rest = int(np.searchsorted(line, line[ej], "right")) - 1 - ej + di - int(np.searchsorted(line, line[di]))
                    near = rest <= max(gap, 0) + 1
                if near and t + pj - max(ep, pi - 1) > total:
                    total, before = t + pj - max(ep, pi - 1), k
        chain.append((di, dj, pi, pj, total, before, places))
        by_end.setdefault(pj, []).append(len(chain) - 1)
        if best < 0 or total > chain[best][4]:
            best = len(chain) - 1
    if best < 0:
        return 0, 0.0
    words, hi, places, k = chain[best][4], chain[best][3], 0, best
    while k >= 0:
        places |= chain[k][6]
        lo, k = chain[k][2], chain[k][5]
    span = steps.weights[lo : hi + 1]
    known = np.array([places >> j & 1 for j in range(lo, hi + 1)], bool)
    return words, float(span[known].sum() / span.sum()) if span.sum() else 1.0


def leaked(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, item_id, words): every document with every item of which it holds the
    passage or at least ``least`` of its words in sequence.

    items: (item_id, passage). Null, empty and blank texts and passages of fewer than
    ``least`` words give no row; words missing or replaced within a run count for their share of
    its weight (``common_run``); repeated items and documents count once each. Documents are
    tokenised once, over the vocabulary of all passages, and written to the shared checkpoint
    folder; every later pass is over term ids. The driver and the tasks hold the passages'
    vocabulary, its vectors and at most BLOCK passages.
    """
    rows = items.where("item_id is not null and passage is not null").select(F.col("item_id").cast("long").alias("item_id"), "passage").dropDuplicates(["item_id"])
    passages = Passages.of(sorted((r.item_id, r.passage) for r in rows.toLocalIterator()))
    size = len(passages.terms)
    if not size:
        return documents.sparkSession.createDataFrame([], "doc_id long, item_id long, words int")
    tokens = cut(token_rows(documents, passages.terms, key, text))
    pairs = np.unique(np.concatenate([step_codes(s, size) for s in passages.sequences if len(s) > 1] or [np.array([-2])]))
    n, df = document_frequencies(tokens, size, pairs)
    weights = term_weights(df, n, passages.sequences, least)
    space = latent_space(tokens, passages, weights)
    out = None
    for lo in range(0, max(1, len(passages.item_ids)), BLOCK):
        found = _candidates(tokens, passages.item_ids[lo : lo + BLOCK], passages.sequences[lo : lo + BLOCK], weights, space.basis, least)
        out = found if out is None else out.unionByName(found)
    return out.groupBy("doc_id", "item_id").agg(F.max("words").alias("words"))


def _candidates(tokens: DataFrame, item_ids: list, sequences: list[np.ndarray], weights: np.ndarray, basis: np.ndarray, least: int) -> DataFrame:
    owner, *entries = windows(sequences, weights)
    chunk = unit(dense(*entries, basis))
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])  # a passage's chunks stand together

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps: dict[int, Steps] = {}
        for b in batches:
            out = []
            docs = [of_bytes(raw) for raw in b["ids"]]
            who, *own = windows([d for d, _ in docs], weights)
            pairs = set()
            if len(chunk) and len(who):
                x = unit(dense(*own, basis))
                for lo in range(0, len(x), 4096):
                    near = np.maximum.reduceat(x[lo : lo + 4096] @ chunk.T, first, axis=1)
                    r, c = np.nonzero(near >= COSINE)
                    pairs.update(zip(who[lo + r].tolist(), owner[first[c]].tolist()))
            last, codes = -1, None
            for k, item in sorted(pairs):
                if k != last:
                    last, codes = k, step_codes(docs[k][0], len(weights))
                if item not in steps:
                    steps[item] = Steps(sequences[item], len(weights), weights)
                words, answer = common_run(codes, docs[k][1], steps[item], least)
                if words * answer >= least and answer >= ANSWER:
                    out.append((b["doc_id"].iloc[k], item_ids[item], words))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "words"])

    return tokens.mapInPandas(work, "doc_id long, item_id long, words int")

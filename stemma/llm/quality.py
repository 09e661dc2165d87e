"""Per-document text quality statistics and structural profiles.

Lines are distributions of function words and character classes; the Jensen-Shannon
divergence from language and structure profiles says what they are.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.edits import undo_encoding

# --- fixed values: function words of the languages ---------------------------------
COMMON_WORDS = {
    "en": "the a an and or but of to in on at for with from by is are was were be been it its this that these those he she they we you i me him her us them my your his our their not no do does did have has had what who where when why how there here if then so as than can will would could should must just about".split(),
    "de": "der die das ein eine einen einem und oder aber von zu in im auf an für mit aus bei ist sind war waren sein es dies diese er sie wir ihr du ich mich mir dir ihn uns nicht kein keine nein ja haben hat hatte was wer wo wann warum wie da hier wenn dann so als doch noch nur schon kann will soll muss man mal den dem des denn bitte".split(),
    "fr": "le la les l un une des et ou mais de du à au aux dans sur pour avec par est sont était être ce cet cette ces il elle ils nous vous tu je j me te se m t s lui on ne n pas non oui que qu qui quoi où quand pourquoi comment y en si alors comme plus c d a ont as sans tout rien va".split(),
    "es": "el la los las un una unos y o pero de del a al en con por para sin es son era ser estar está esta este eso esto él ella ellos nosotros tú yo me te se le lo les nos mi tu su no ni sí que quién qué dónde cuándo cómo si como más muy ya hay ha he había todo nada aquí".split(),
}
#: What the signs of a line are: letters of function words, of other words by their case, of
#: unreadable words and of words said over and over; digits; sentence marks and commas; cell
#: borders; item marks; dashes; all other signs.
SIGNS = ("function", "lower", "capital", "shout", "odd", "again", "number", "end", "comma", "cell", "item", "dash", "symbol")
#: The shares of the signs in lines of each kind, each kind in several forms; shares not named are 0.
PROFILES = {
    "prose": (
        "function .40 lower .49 capital .02 number .01 end .07 comma .01", "function .31 lower .38 capital .20 number .01 end .08 comma .02", "function .07 lower .66 end .27", "function .38 shout .42 number .01 end .15 comma .02 dash .02", "function .19 capital .49 again .04 end .25 dash .03",
        "function .31 lower .36 capital .11 again .03 end .10 comma .03 dash .06", "function .05 lower .38 capital .34 end .18 dash .05", "function .45 lower .25 capital .05 end .25", "function .20 lower .72 capital .08",
    ),
    "list": (
        "capital .90 item .06 dash .03 end .01", "capital .76 number .10 item .06 end .05 symbol .03", "shout .93 item .04 dash .03", "function .19 lower .43 number .13 item .20 cell .03 dash .02", "function .14 lower .36 number .17 item .17 end .16", "lower .52 number .15 end .08 item .25",
        "function .10 lower .67 capital .03 comma .20", "function .20 capital .42 number .10 item .20 end .05 symbol .03", "function .10 lower .62 item .28", "lower .50 number .25 item .20 cell .05", "capital .80 dash .20", "shout .60 number .15 item .25", "function .33 lower .35 capital .10 number .05 end .08 item .09",
    ),
    "table": (
        "lower .16 number .39 cell .36 end .04 item .03 dash .01 symbol .01", "shout .06 number .31 cell .49 end .05 dash .05 symbol .04", "lower .30 shout .10 number .10 cell .45 dash .05", "cell .35 dash .65", "shout .03 number .45 cell .33 end .06 item .10 symbol .03", "shout .30 number .15 cell .45 dash .05 symbol .05",
    ),
    "junk": (
        "function .08 lower .05 odd .09 number .03 end .20 cell .23 symbol .32", "lower .05 capital .03 shout .03 odd .28 end .07 symbol .54", "function .02 lower .02 capital .07 odd .72 number .15 symbol .02", "function .30 lower .05 capital .05 odd .12 number .08 end .12 cell .06 item .02 symbol .20",
        "again 1", "symbol 1", "function .10 again .90", "dash 1", "end .70 dash .30",
    ),
}
#: What a mark counts for beside a letter.
MARK_WEIGHTS = {"last end": 2.0, "comma": 2.0, "cell": 3.0, "bullet": 4.0, "first dash": 3.0, "first number": 3.0}
# -----------------------------------------------------------------------------------
#: The divergences of the lines beside a line count for this much of its own, the nearest first;
#: a line counts by its signs, at most LINE_SIGNS of them.
BESIDE, LINE_SIGNS = (0.5, 0.25), 40
#: Share of function words in the prose of every language.
FUNCTION_SHARE = 0.5
#: Words back within which a word is said again.
NEAR_WORDS = 3
#: Signs that are measured at once, and signs of a piece of a longer line.
CHUNK, PIECE = 1_000_000, 20_000

_HEADER = re.compile(r"\A\s*WEBVTT[^\n]*\n(?:[A-Za-z-]+: ?[^\n]*\n)*")
_TIME = re.compile(r"[^>]*[\dOoIl]{1,3} ?[:.;] ?[\dOoIl]{2}\b[^>]*[-–—] ?>")
_LONE_NUMBER = re.compile(r"[\dOoIl]{1,6}$")
_MARKUP = re.compile(r"</?[A-Za-z][^<>\n]{0,80}>|\{\\[^{}\n]{0,60}\}|&(?:amp|lt|gt|quot|nbsp|#\d+);")
_ADVERT = re.compile(r"https?:|www\.|\w@\w|\w\.(?:invalid|example|test|com|net|org)\b|\bVIP\b|remove all ads|^\W*(?:encoded|ripped|synced|subtitles?|captions?|translated|sous-titres|untertitel|subtítulos)\b.{0,12}\b(?:by|par|von|por|offerts)\b|^-= .* =-$", re.I)
#: Every advert holds one of these, in lower case.
_ADVERT_SIGNS = ("http", "www.", "@", ".invalid", ".example", ".test", ".com", ".net", ".org", "vip", "remove all ads", "-= ", "encoded", "ripped", "synced", "subtitle", "caption", "translated", "sous-titres", "untertitel", "subtítulos")
_SOUND = re.compile(r"\[[^\W\d_][^\W\d_ ,.'’-]*(?:[ ,.'’-]+[^\W\d_]+){0,7}[.…]?\]|\([^\W\d_]+(?:[ ,.'’-]+[^\W\d_]+){0,7}[.…]?\)|\*[^\W\d_]+(?: [^\W\d_]+){0,5}\*|[♪♫]+|(?<!\S)#(?!\S)")
LANGS = tuple(COMMON_WORDS)
KINDS = tuple(PROFILES)
_LOWER, _UPPER, _OTHER, _DIGIT, _SPACE, _LINE, _MARK, _SYMBOL, _CELL, _BULLET, _DASH = range(11)
_TOP = 0x10000  # all signs from here on count as one


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, ...]:
    """By code point: class, script of letters, is it a vowel, its small letter; and the
    powers, the function words' hashes and the languages they belong to."""
    kind, script = np.full(_TOP + 1, _SYMBOL, np.uint8), np.zeros(_TOP + 1, np.uint8)
    vowel, small, scripts = np.zeros(_TOP + 1, bool), np.arange(_TOP + 1, dtype=np.uint64), {}
    for c in range(_TOP):
        sign = chr(c)
        cat = unicodedata.category(sign)
        if cat[0] == "L":
            name = unicodedata.name(sign, "?").split()[0].split("-")[0]
            name = "CJK" if name in ("HIRAGANA", "KATAKANA") or c == 0x30FC else name
            script[c] = scripts.setdefault(name, len(scripts) + 1)
            kind[c] = _UPPER if cat in ("Lu", "Lt") else _LOWER if cat == "Ll" else _OTHER
            vowel[c] = c < 0x250 and unicodedata.normalize("NFKD", sign.lower())[0] in "aeiouyæœøı"
            if len(low := sign.lower()) == 1 and ord(low) < _TOP:
                small[c] = ord(low)
        elif cat[0] == "M":
            kind[c] = _OTHER
        elif cat == "Nd":
            kind[c] = _DIGIT
        elif sign.isspace():
            kind[c] = _SPACE
    for signs, k in (("\n", _LINE), (".,?!'’\"…:¿¡«»“”„‘`´、。！？「」，", _MARK), ("-–—‐", _DASH), ("\t|;", _CELL), ("*•·▪◦‣", _BULLET)):
        kind[[ord(x) for x in signs]] = k
    powers = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
    words = sorted(set().union(*COMMON_WORDS.values()))
    code = lambda w: small[np.frombuffer(w.encode("utf-32-le"), np.uint32)]
    hashes = np.array([(code(w) * powers[: len(w)]).sum() for w in words], np.uint64)
    order = np.argsort(hashes)
    of = np.array([[w in COMMON_WORDS[lang] for lang in LANGS] for w in words], bool)
    # the n-th word of a language's list has a share in proportion to 1 / (n + 2)
    share = np.array([[1 / (COMMON_WORDS[lang].index(w) + 2) if w in COMMON_WORDS[lang] else 0.0 for lang in LANGS] for w in words])
    return kind, script, vowel, small, powers, hashes[order], of[order], (share / share.sum(0))[order]


@lru_cache(maxsize=1)
def _profiles() -> tuple[np.ndarray, np.ndarray]:
    """The profiles as rows of shares, and the kind of each."""
    out = []
    for form in (f for forms in PROFILES.values() for f in forms):
        parts = form.split()
        row = np.full(len(SIGNS), 0.002)
        for sign, share in zip(parts[::2], parts[1::2]):
            row[SIGNS.index(sign)] += float(share)
        out.append(row / row.sum())
    return np.array(out), np.repeat(np.arange(len(KINDS)), [len(p) for p in PROFILES.values()])


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log2(np.maximum(x, 1e-12))


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergences in bits, 0 to 1, of the rows of p from those of q."""
    own, out = _xlogx(p).sum(1), np.empty((len(p), len(q)))
    for j, row in enumerate(q):
        out[:, j] = (own + _xlogx(row).sum()) / 2 - _xlogx((p + row) / 2).sum(1)
    return np.clip(out, 0.0, 1.0)


def visible_lines(text: str) -> list[str]:
    """The lines of a subtitle text without headers, cue numbers, times, mark-up and adverts."""
    text = undo_encoding(text.lstrip("﻿")).replace("\r\n", "\n").replace("\r", "\n")
    text = _HEADER.sub("", text) if "WEBVTT" in text[:40] else text
    if "<" in text or "{\\" in text or "&" in text:
        text = _MARKUP.sub("", text)
    low = text.lower()
    adverts = any(sign in low for sign in _ADVERT_SIGNS)
    out = []
    for line in text.split("\n"):
        line = line.strip()
        if not line or ">" in line and _TIME.match(line) or len(line) < 7 and _LONE_NUMBER.match(line) or adverts and _ADVERT.search(line):
            continue
        out.append(line)
    return out


def _spoken(line: str) -> str:
    """A line without sound descriptions and signs of songs."""
    return _SOUND.sub("", line).strip() if "[" in line or "(" in line or "*" in line or "♪" in line or "#" in line else line


def _pieces(line: str) -> Iterator[str]:
    """A line in pieces of at most PIECE signs, cut at white space where there is any."""
    lo = 0
    while len(line) - lo > PIECE:
        at = line.rfind(" ", lo, lo + PIECE)
        at = at if at > lo else lo + PIECE
        yield line[lo:at]
        lo = at
    yield line[lo:]


def line_signs(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lines x languages x signs: the weight of each sign in each line when the function
    words are those of a language; line and number of each function word; of each line
    its words, their letters, all signs but white space, and 1 for an end mark).

    All lines are measured together: classes by a table, words as runs of letters, known
    words by their hash."""
    kind_of, script_of, vowel_of, small, powers, hashes, of, _ = _tables()
    n = len(lines)
    code = np.minimum(np.frombuffer(("\n".join(lines) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32), _TOP).astype(np.int64)
    kind = kind_of[code]
    ends = np.flatnonzero(kind == _LINE)
    line = np.repeat(np.arange(n), np.diff(np.r_[-1, ends]))
    starts = np.r_[0, ends[:-1] + 1]
    out = np.zeros((n, len(LANGS), len(SIGNS)), np.float32)
    counts = np.zeros((n, 4), np.int64)
    found_line = found_word = np.empty(0, np.int64)

    def add(sign: str, at: np.ndarray, weight: float = 1.0) -> None:
        out[:, :, SIGNS.index(sign)] += (np.bincount(line[at], minlength=n) * weight)[:, None]

    after, before = np.r_[kind[1:], _LINE], np.r_[_LINE, kind[:-1]]
    letter = kind <= _OTHER
    edge = np.diff(np.r_[False, letter, False].astype(np.int8))
    first, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(first):
        size, of_line = stop - first, line[first]

        def within(mask: np.ndarray) -> np.ndarray:
            total = np.r_[0, np.cumsum(mask)]
            return total[stop] - total[first]

        script = script_of[code]
        uppers, vowels = within(kind == _UPPER), within(vowel_of[code])
        humps = within((kind == _UPPER) & (before == _LOWER))
        turns = within(np.r_[False, (script[1:] != script[:-1]) & (script[1:] > 0) & (script[:-1] > 0)])
        latin = script[first] == script_of[ord("a")]
        place = np.arange(len(code)) - np.repeat(np.r_[0, first], np.diff(np.r_[0, first, len(code)]))
        hashed = np.add.reduceat(np.where(letter, small[code] * powers[place & 63], np.uint64(0)), first)
        variety = np.bitwise_count(np.bitwise_or.reduceat(np.where(letter, np.uint32(1) << (code & 31).astype(np.uint32), np.uint32(0)), first))
        at = np.minimum(np.searchsorted(hashes, hashed), len(hashes) - 1)
        known = hashes[at] == hashed
        left, right = before[first], kind[stop]
        tight = np.isin(left, (_SYMBOL, _DIGIT, _CELL, _BULLET)) | np.isin(right, (_SYMBOL, _DIGIT, _BULLET))
        alone = (size == 1) & (left != _MARK) & (right != _MARK)
        odd = (humps > 0) & (humps + (uppers > 1) > 1) | (turns > 0) | latin & ((vowels == 0) & (size > 3) | (size > 25)) | ~known & latin & ((size <= 2) & tight | alone)
        order = np.lexsort((first, hashed, of_line))
        said = np.zeros((2, len(first)), bool)  # shortly before in the line: once, twice
        for k in (1, 2):
            here, there = order[k:], order[:-k]
            said[k - 1][here] = (hashed[here] == hashed[there]) & (of_line[here] == of_line[there]) & (here - there <= NEAR_WORDS * k)
        again = np.where(known, said[1], said[0]) | (size >= 8) & (variety <= 3) & latin
        case = np.where((uppers == size) & (size > 1), 3, np.where(uppers > 0, 2, 1))
        for k in range(len(LANGS)):
            sign = np.where(again, 5, np.where(known & of[at, k], 0, np.where(odd & ~known, 4, case)))
            out[:, k] += np.bincount(of_line * len(SIGNS) + sign, size, n * len(SIGNS)).reshape(n, -1)
        found_line, found_word = of_line[known], at[known]
        counts[:, 0], counts[:, 1] = np.bincount(of_line, minlength=n), np.bincount(of_line, size, n)
        # a number behind the first word of a line numbers it, if that has a capital
        words_before = np.r_[0, np.cumsum(edge[:-1] == 1)]
    else:
        words_before = np.zeros(len(code) + 1, np.int64)
    digit_starts = np.flatnonzero((kind == _DIGIT) & (before != _DIGIT))
    rank = words_before[digit_starts] - words_before[starts[line[digit_starts]]]
    firsts = np.ones(len(digit_starts), bool)
    firsts[1:] = line[digit_starts[1:]] != line[digit_starts[:-1]]
    lead = digit_starts[firsts & ((rank == 1) & (kind[starts[line[digit_starts]]] == _UPPER) | (digit_starts - starts[line[digit_starts]] <= 1))]
    add("item", lead, MARK_WEIGHTS["first number"])
    add("number", np.flatnonzero(kind == _DIGIT))
    comma = code == ord(",")
    tight_comma = comma & (after != _SPACE) & (after != _LINE)
    wide = (kind == _SPACE) & (after == _SPACE) & (before != _SPACE) & (before != _LINE)
    between = (kind == _SPACE) & (after == _DIGIT) & (before == _DIGIT)
    add("cell", np.flatnonzero((kind == _CELL) | tight_comma | wide | between), MARK_WEIGHTS["cell"])
    add("comma", np.flatnonzero(comma & ~tight_comma), MARK_WEIGHTS["comma"])
    add("end", np.flatnonzero((kind == _MARK) & ~comma))
    last = ends - 1
    add("end", last[(last >= starts) & (kind[last] == _MARK) & ~comma[last]], MARK_WEIGHTS["last end"])
    front = np.zeros(len(code), bool)
    front[starts] = True
    add("item", np.flatnonzero((kind == _BULLET) & front), MARK_WEIGHTS["bullet"])
    add("dash", np.flatnonzero((kind == _DASH) & front), MARK_WEIGHTS["first dash"])
    add("dash", np.flatnonzero((kind == _DASH) & ~front))
    add("symbol", np.flatnonzero((kind == _SYMBOL) | (kind == _BULLET) & ~front))
    counts[:, 2] = np.bincount(line[(kind != _SPACE) & (kind != _LINE) & (code != 9)], minlength=n)
    counts[:, 3] = (last >= starts) & ((kind[last] == _MARK) & ~comma[last] | np.isin(code[last], (ord(";"), ord(")"))))
    return out, found_line, found_word, counts


def describe_many(texts: list[str | None]) -> pd.DataFrame:
    """The statistics of texts, columns as in FIELDS; see ``quality_stats``."""
    n = len(texts)
    lines, doc = [], []
    for k, t in enumerate(texts):
        for x in visible_lines(t) if t else ():
            for piece in _pieces(x):
                lines.append(piece)
                doc.append(k)
    doc = np.array(doc, np.int64)
    spoken = [_spoken(x) for x in lines]
    parts, lo, size = [], 0, 0
    for hi in range(len(spoken) + 1):  # so many signs at once
        if hi == len(spoken) and hi > lo or size > CHUNK:
            signs, at, word, made = line_signs(spoken[lo:hi])
            parts.append((signs, at + lo, word, made))
            lo, size = hi, 0
        if hi < len(spoken):
            size += len(spoken[hi]) + 1
    _, _, _, _, _, hashes, of, share = _tables()
    none = np.empty(0, np.int64)
    signs, at, word, made = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros((0, len(LANGS), len(SIGNS)), np.float32), none, none, np.zeros((0, 4), np.int64))
    of_doc = lambda x: np.bincount(doc, x, n) if len(doc) else np.zeros(n)
    n_words, letters, solid = of_doc(made[:, 0]).astype(np.int64), of_doc(made[:, 1]), made[:, 2]
    # the language whose function words are spread most like the document's
    counts = np.zeros((n, len(hashes) + 1))
    counts += np.bincount(doc[at] * counts.shape[1] + word, minlength=counts.size).reshape(counts.shape)
    known = counts.sum(1)
    counts[:, -1] = np.maximum(n_words - known, 0)
    by_lang = divergences(counts / np.maximum(counts.sum(1), 1)[:, None], np.c_[share.T * FUNCTION_SHARE, np.full(len(LANGS), 1 - FUNCTION_SHARE)])
    lang = by_lang.argmin(1)
    own = signs[np.arange(len(doc)), lang[doc]].astype(np.float64)
    total = own.sum(1)
    q, kind_of_profile = _profiles()
    near = divergences(own / np.maximum(total, 1e-9)[:, None], q)
    by_kind = np.stack([near[:, kind_of_profile == k].min(1) for k in range(len(KINDS))], 1)
    weighed = by_kind * np.minimum(total, LINE_SIGNS)[:, None]
    cost = weighed.copy()
    for k, part in enumerate(BESIDE, 1):
        same = doc[k:] == doc[:-k]
        cost[k:][same] += part * weighed[:-k][same]
        cost[:-k][same] += part * weighed[k:][same]
    kind = cost.argmin(1)
    chars = np.stack([np.bincount(doc[kind == k], solid[kind == k], n) for k in range(len(KINDS))], 1).astype(np.int64) if len(doc) else np.zeros((n, len(KINDS)), np.int64)
    solid_total = np.maximum(chars.sum(1), 1)
    nearest = chars.argmax(1)
    mean = of_doc(by_kind[np.arange(len(doc)), nearest[doc]] * solid) / solid_total
    n_lines = np.bincount(doc, minlength=n)
    odd = of_doc(own[:, SIGNS.index("symbol")] + own[:, SIGNS.index("cell")] / MARK_WEIGHTS["cell"])
    others, solid_any = chars[:, 1:].sum(1), chars.sum(1) > 0
    ratio = lambda a, b: [float(x) / float(y) if y else None for x, y in zip(a, b)]
    doc_kind = [None if not v else KINDS[1 + int(c[1:].argmax())] if 2 * o > c.sum() else KINDS[0] for v, o, c in zip(solid_any, others, chars)]
    return pd.DataFrame({
        "n_words": n_words, "n_lines": n_lines, "mean_word_length": ratio(letters, n_words), "symbol_ratio": ratio(odd, of_doc(solid)), "end_mark_share": ratio(of_doc(made[:, 3]), n_lines), "common_word_share": ratio(known, n_words),
        "nearest_lang": [LANGS[k] if v else None for k, v in zip(lang, known > 0)], "word_divergence": [float(by_lang[k, lang[k]]) if n_words[k] else None for k in range(n)], "nearest_profile": [KINDS[k] if v else None for k, v in zip(nearest, solid_any)], "profile_divergence": [float(x) if v else None for x, v in zip(mean, solid_any)],
        "speech_chars": chars[:, 0], "list_chars": chars[:, 1], "table_chars": chars[:, 2], "junk_chars": chars[:, 3], "doc_kind": doc_kind,
    })


FIELDS = "n_words long, n_lines long, mean_word_length double, symbol_ratio double, end_mark_share double, common_word_share double, nearest_lang string, word_divergence double, nearest_profile string, profile_divergence double, speech_chars long, list_chars long, table_chars long, junk_chars long, doc_kind string"


def quality_stats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of statistics per row of df.

    Counts are of the visible text: without headers, cue numbers, times, mark-up,
    adverts and sound descriptions. The language is the one whose function words are spread most like the
    document's, by Jensen-Shannon divergence. Each line is a distribution of SIGNS, its
    function words being those of that language, and takes the kind of the nearest profile,
    the divergences of the lines beside it counting with it. doc_kind is
    'prose' unless more than half of the characters are not running speech, then the most
    frequent other kind; nearest_profile is the kind of most characters and
    profile_divergence the mean divergence from it. Null, empty and blank texts and texts with
    nothing visible have 0 counts, null shares and a null doc_kind. Whole texts are read;
    a line of more than PIECE signs is measured in pieces; repeated rows each get a row. No shuffle.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, lo, size = b["_text"].tolist(), 0, 0
            for hi in range(len(texts) + 1):
                if hi == len(texts) and hi > lo or size > 2 * CHUNK:
                    made = describe_many(texts[lo:hi])
                    made.insert(0, key, b["_key"].iloc[lo:hi].to_numpy())
                    yield made
                    lo, size = hi, 0
                if hi < len(texts):
                    size += len(texts[hi] or "")

    return df.select(F.col(key).cast("long").alias("_key"), F.col(text).cast("string").alias("_text")).mapInPandas(work, f"`{key}` long, {FIELDS}")

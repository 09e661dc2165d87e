"""Edit distances and text folding shared by the name and list operators."""

from __future__ import annotations

import re
import unicodedata

import numpy as np

# --- fixed values: signs that scanners and typists confuse -------------------------
CONFUSED = {frozenset(p) for p in ("0o", "1l", "1i", "il", "ce", "5s", "8b", "nu", "uv", "vw", "mn", "gq", "ao", "ae", "ei", "ou", "sz", "ck", "td", "bp", "iy", "rt", "hb", "ij")}
# -----------------------------------------------------------------------------------
_DIGIT_LETTERS = str.maketrans("015", "ols")
_NOT_WORD = re.compile(r"[\W_]+")


def undo_encoding(text: str) -> str:
    """A text whose UTF-8 was read as a one-byte encoding, read rightly; else as it is."""
    if "Ã" in text or "Â" in text or "â" in text or "Å" in text:
        for wrong in ("cp1252", "latin-1"):
            try:
                return text.encode(wrong).decode("utf-8")
            except UnicodeError:
                pass
    return text


def fold(text: str) -> str:
    """Lower case without accents, encoding errors undone."""
    text = unicodedata.normalize("NFKD", undo_encoding(text))
    return "".join(c for c in text if not unicodedata.combining(c)).replace("ß", "ss").lower()


def skeleton(text: str) -> str:
    """The letters of a text, folded; digits within a word with letters as the letters they look like."""
    text = fold(text)
    if any(c.isdigit() for c in text) and any(c.isalpha() for c in text):
        text = text.translate(_DIGIT_LETTERS)
    return _NOT_WORD.sub("", text)


def deletes(word: str, most: int) -> set[str]:
    """The word and all words that up to ``most`` deletions make of it."""
    out, last = {word}, {word}
    for _ in range(most):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out |= last
    return out


def weighted_distance(a: str, b: str, cut: float = 9.0) -> float:
    """Damerau-Levenshtein distance (neighbours may change places) in which signs that look
    alike cost 0.5, doubled or single letters 0.7 and other edits 1."""
    if a == b:
        return 0.0
    n, m = len(a), len(b)
    if abs(n - m) * 0.7 > cut:
        return cut
    before: list[float] = []
    last = [0.0]
    for j in range(m):
        last.append(last[j] + 1.0)
    for i in range(1, n + 1):
        now = [last[0] + 1.0]
        x = a[i - 1]
        for j in range(1, m + 1):
            y = b[j - 1]
            if x == y:
                v = last[j - 1]
            else:
                v = last[j - 1] + (0.5 if frozenset((x, y)) in CONFUSED else 1.0)
            v = min(v, last[j] + (0.7 if i > 1 and a[i - 2] == x else 1.0), now[j - 1] + (0.7 if j > 1 and b[j - 2] == y else 1.0))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 0.9)
            now.append(v)
        before, last = last, now
    return last[m]


def damages(a: str, b: str) -> int:
    """Letters changed, lost or added and neighbours that changed places, between two words."""
    before: list[int] = []
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            v = min(last[j] + 1, now[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            now.append(v)
        before, last = last, now
    return last[-1]


# --- fixed values: letters that scanners confuse, as one letter each ----------------
ALIKE = str.maketrans("ljfcbqv", "iitehgu")
# -----------------------------------------------------------------------------------


def alike(word: str) -> str:
    """A word under which letters meet that scanners confuse."""
    return word.translate(ALIKE)


def half_edits(a: str, b: str) -> int:
    """The edit metric of names, in half edits: a letter lost, added or changed costs two, a
    change within the letters that scanners confuse one. These costs of changes are a
    metric on letters and no change costs more than a loss and an addition, so the
    least cost of turning a word into another is a metric on words."""
    last = list(range(0, 2 * len(b) + 1, 2))
    fa, fb = alike(a), alike(b)
    for i, x in enumerate(a):
        now = [2 * i + 2]
        for j, y in enumerate(b):
            now.append(min(last[j + 1] + 2, now[j] + 2, last[j] + (x != y) + (fa[i] != fb[j])))
        last = now
    return last[-1]


def coded(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as rows of code points, the same with confused letters as one, and their
    lengths; the rows are as wide as the longest word."""
    width = max(map(len, words), default=0)
    grids = []
    for form in (words, list(map(alike, words))):
        grid = np.zeros((len(words), width), np.uint32)
        for k, w in enumerate(form):
            grid[k, : len(w)] = np.frombuffer(w.encode("utf-32-le", "surrogatepass"), np.uint32)
        grids.append(grid)
    return *grids, np.array([len(w) for w in words], np.int32)


def half_edit_pairs(a: tuple, i: np.ndarray, b: tuple, j: np.ndarray) -> np.ndarray:
    """half_edits of the coded words a[i] and b[j], pair by pair, one vector step a cell."""
    (xa, fa, na), (xb, fb, nb) = ((x[at], f[at], n[at]) for (x, f, n), at in ((a, i), (b, j)))
    k = len(na)
    if not k:
        return np.empty(0, np.int32)
    wa, wb = int(na.max()), int(nb.max())
    small = np.int8 if 2 * (wa + wb) < 120 else np.int32
    last = np.broadcast_to((2 * np.arange(wb + 1)).astype(small)[:, None], (wb + 1, k)).copy()
    out = np.where(na == 0, 2 * nb, 0).astype(np.int32)
    end, xb, fb = nb.astype(np.int64)[None], np.ascontiguousarray(xb.T), np.ascontiguousarray(fb.T)
    for p in range(1, wa + 1):
        now = np.empty_like(last)
        now[0] = 2 * p
        x, f = xa[:, p - 1], fa[:, p - 1]
        for q in range(1, wb + 1):
            change = (xb[q - 1] != x).view(np.int8) + (fb[q - 1] != f).view(np.int8)
            now[q] = np.minimum(np.minimum(last[q], now[q - 1]) + 2, last[q - 1] + change)
        last = now
        done = na == p
        if done.any():
            out = np.where(done, np.take_along_axis(last, end, 0)[0], out)
    return out

import numpy as np
import pytest

from stemma.llm.quality import COMMON_WORDS, PIECE, SIGNS, describe_many, divergences, line_signs, quality_stats

CUE = "1\n00:00:01,000 --> 00:00:02,000\n{}\n\n"
CASES = {
    "prose": CUE.format("- I told you the door was open.\n- No, it was not.") * 3, "list": CUE.format("1. ferry\n2. barn\n3. neighbour") * 3, "table": CUE.format("12\t33%\tMO\n-\t4:05\tTI") * 3, "junk": CUE.format("*^;'~|e^|!ry{~. '*r|e^^{s{w\n@#|~_;*<>+=~") * 3,
}


def stats(text):
    return describe_many([text]).iloc[0].to_dict()


@pytest.mark.parametrize("kind", CASES)
def test_kinds(kind):
    assert stats(CASES[kind])["doc_kind"] == kind


@pytest.mark.parametrize("text,kind", [("hahahahahahahahahahahahaha\n" * 3, "junk"), ("HOW MANY TIMES DO I HAVE TO TELL YOU?", "prose"), ("Â¿QuÃ© quieres que haga yo?", "prose"), ("what d0 you want me to do with fhe storm?", "prose"), ("LdyWP/3OR0ho0mMr+oiqoXHA60aK6BhUxePnigsSvlOD9\n74mdlOBuXsS/lwvLhTWo3udWS8X5e5ZFpHiXcs+mhEy", "junk"), ("| - | 0:05 | 53 |\n|---|---|---|\n| 23 | - | lostu |", "table"), ("well; no", "prose"), ("#### #### ####\n" * 4, "junk"), ("la la la la la la la la la\n" * 4, "junk"), ("PUPI GOHAKAI\nLUZU HANEMOU\nSTIRAI ZULEVAI\nSTAVA STULOUKI", "list"), ("No, no, no!\nCome on.", "prose"), ("0.12 0.44 0.99 1.02\n" * 10, "table"), ("anna\tred\t3\nbela\tblue\t44\n" * 5, "table"), ("Привет, как дела?\nЯ не знаю, что сказать.", "prose"), ("これはペンです。\n私は学生です。", "prose"), ("й▰คぇถи▅┄ถ▤ัあ▅┍▥にぇ┕จ\n┖てฤЌ▚ぞ▍▵ぞา┟", "junk"), ("Ch. 1: The window\nCh. 2: The choir and the dog\nCh. 3: The stolen van", "list")])
def test_hard_lines(text, kind):
    assert stats(text)["doc_kind"] == kind


def test_more_than_half_decides():
    speech, entries = "She never said that it was closed.\n", "7. second letter\n"
    assert stats(speech * 3 + entries)["doc_kind"] == "prose" and stats(speech + entries * 9)["doc_kind"] == "list"


def test_what_is_left_aside():
    s = stats("﻿WEBVTT\nKind: captions\n\n12\nO0:00:01.000 —> 00:00:02.000\n<i>Wait.</i> {\\an8}[door slams]\n\nSubtitles by www.subs.example\n")
    assert (s["n_words"], s["n_lines"], s["speech_chars"], s["doc_kind"]) == (1, 1, 5, "prose")


def test_counts_and_divergence():
    s = stats("I told you so.\nthe red ferry")
    assert (s["n_words"], s["n_lines"], s["end_mark_share"]) == (7, 2, 0.5) and s["mean_word_length"] == 3
    assert s["common_word_share"] == pytest.approx(4 / 7) and s["nearest_lang"] == "en"
    p = np.array([[1.0, 0.0], [0.5, 0.5]])
    assert divergences(p, p) == pytest.approx(np.array([[0, 0.3113], [0.3113, 0]]), abs=1e-4) and divergences(p[:1], np.array([[0.0, 1.0]])) == pytest.approx(np.array([[1.0]]))


def test_signs_against_a_plain_count():
    rows = ["the Red ferry, 12 OLD dogs", "", "* x9 der Hund!", "l|l{ aBcD"]
    signs, line, word, counts = line_signs(rows)
    en, de = signs[:, list(COMMON_WORDS).index("en")], signs[:, list(COMMON_WORDS).index("de")]
    of = lambda x, k, sign: x[k, SIGNS.index(sign)]
    assert [of(en, 0, s) for s in ("function", "capital", "lower", "shout", "number", "comma")] == [3, 3, 9, 3, 2, 2]
    assert of(de, 2, "function") == 3 and of(en, 2, "function") == 0 and of(en, 2, "end") == 3 and of(en, 2, "item") >= 4
    assert en[1].sum() == 0 and of(en, 3, "odd") == 4 and sorted(set(line.tolist())) == [0, 2, 3] and counts.tolist() == [[5, 18, 21, 0], [0] * 4, [3, 8, 11, 1], [3, 6, 8, 0]]


def known(row):
    return {k: v for k, v in row.items() if v is not None and v == v}


def test_texts_do_not_touch_each_other():
    texts = [CASES[k] for k in CASES] + [None, "", CASES["list"]]
    together, apart = describe_many(texts), [stats(t) for t in texts]
    for k, own in enumerate(apart):
        assert known(together.iloc[k].to_dict()) == known(own)


def test_a_long_line_is_measured_in_pieces():
    s = stats("She never said that it was closed. " * PIECE)
    assert s["doc_kind"] == "prose" and s["n_words"] == 7 * PIECE


def test_operator_defines_empty_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "1\n00:00:01,000 --> 00:00:02,000\n"), (5, CASES["prose"]), (5, CASES["prose"]), (6, "word " * 100_000)]
    got = quality_stats(spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_words int")).collect()
    assert len(got) == 7 and all(r.doc_kind is None and r.n_words == 0 for r in got if r.doc_id < 5)
    assert quality_stats(spark.createDataFrame([], "doc_id long, text string")).count() == 0

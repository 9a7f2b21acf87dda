"""Word tokens: equal to a step-by-step form, and in linear time on long texts."""

import random
import re
import time

from verisift.functions import checkers
from verisift.functions import tokens as K

#: Marks that end no sentence, so that all of it is one piece.
ONE_PIECE = "NASA etc. ESA and more words of the same sort, "
POOL = [*"ab A.!?.. \n\t\"')]” ,;:'-", "Dr. ", "etc. ", "e.g. ", "a. ", "...", "Foo bar baz. ", "x\n. ", "\x1c", "\x85", "é", "cannot ", "GıMME ", "wanna ", "don't ", "“mr. "]


def count_by_steps(text):
    """Sentences, with the text before and after each end mark taken anew."""
    text = text.strip()
    n = 1 if text else 0
    for m in re.finditer(r"([.?!]+)([\"')\]”’]*)(\s+)", text):
        before, rest = re.search(r"(\S+)$", text[: m.start()]), text[m.end() :]
        token = (before[1] if before else "").lstrip("(\"'“").lower()
        if m[1] == ".":
            n += not (token in K.ABBREVIATIONS or re.fullmatch(r"[a-z]", token) or rest[0].islower())
        else:
            n += not (m[1].startswith("...") and rest[0].islower())
    return n


def pieces_by_steps(text):
    text = text.strip()
    out, start = [], 0
    for m in re.finditer(r"([.?!]+)([\"')\]”’]*)(\s+)", text):
        if count_by_steps(text[start : m.end()] + text[m.end() :][:40]) > count_by_steps(text[start : m.start()]):
            out.append(text[start : m.end()].strip())
            start = m.end()
    return [*out, text[start:].strip()] if text else []


def words_by_steps(text):
    """All patterns on every piece, wanted or not."""
    out = []
    for x in pieces_by_steps(text):
        for needs, pattern, to in K.SPLITS:
            x = pattern.sub(to, f" {x} " if needs == ("'",) else x)
        for _, pattern, to in K.RARE_SPLITS:
            x = pattern.sub(to, x)
        out += x.split()
    return out


def test_equal_to_steps():
    rng = random.Random(7)
    for _ in range(4000):
        x = "".join(rng.choice(POOL) for _ in range(rng.randint(0, 60)))
        assert (K.count_sentences(x), K.split_sentences(x), K.word_tokens(x)) == (count_by_steps(x), pieces_by_steps(x), words_by_steps(x)), x


def in_seconds(most, *checks):
    start = time.time()
    for id_, x, params, expected in checks:
        assert checkers.check(id_, x, params) is expected
    assert time.time() - start < most


def test_capital_words_of_long_texts():
    least = {"capital_relation": "at least"}
    id_ = "change_case:capital_word_frequency"
    in_seconds(10, (id_, ONE_PIECE * 800, least | {"capital_frequency": 1600}, True), (id_, ONE_PIECE * 800, least | {"capital_frequency": 1601}, False))


def test_unique_words_of_long_texts():
    x = " ".join(f"one{i} two{i} three{i} four{i} five{i}." for i in range(800))
    in_seconds(10, ("count:count_unique", x, {}, True), ("count:count_unique", x + " one7 ", {}, False))


def test_first_and_last_word_of_long_texts():
    x = "echo " + ONE_PIECE * 800
    in_seconds(10, ("keywords:start_end", x + "echo", {}, True), ("keywords:start_end", x + "echo.", {}, False))

"""Pure-Python tokenisers and a small language guesser, for checks that have no native form.

Sentence counting, word tokenising and language identification follow published
descriptions of the usual tools; they are approximations and say so in the README.
"""

from __future__ import annotations

import json
import re

ABBREVIATIONS = set("mr mrs ms dr prof sr jr st vs etc inc ltd co corp e.g i.e fig no vol al u.s a.m p.m jan feb mar apr jun jul aug sep sept oct nov dec".split())
#: A run of end marks is tried once, at its first mark, so that long runs stay linear.
BREAK = re.compile(r"(?<![.?!])([.?!]++)([\"')\]”’]*+)(\s+)")

#: Abbreviations whose full stop ends no sentence, ends of host names, and words that begin one.
TITLES = ("Mr", "St", "Mrs", "Ms", "Dr")
SUFFIXES = (" Inc", " Ltd", " Jr", " Sr", " Co")
DOMAINS = ("com", "net", "org", "io", "gov", "edu", "me")
TITLES_AND_MORE = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Capt", "Cpt", "Lt", "Wherever")
OPENERS = ("He", "She", "It", "They", "Their", "Our", "We", "But", "However", "That", "This")


def _word_before(text: str, at: int) -> str:
    """The characters between the last white space and ``at``; one line break right before ``at`` is passed over."""
    end = at - 1 if at and text[at - 1] == "\n" else at
    start = end
    while start and not text[start - 1].isspace():
        start -= 1
    return text[start:end]


def _ends_sentence(text: str, m: re.Match) -> bool:
    """Whether the end marks m, which more text follows, end a sentence."""
    after_small = text[m.end()].islower()
    if m[1] == ".":
        token = _word_before(text, m.start()).lstrip("(\"'“").lower()
        return not (token in ABBREVIATIONS or re.fullmatch(r"[a-z]", token) or after_small)
    return not (m[1].startswith("...") and after_small)


def count_sentences(text: str) -> int:
    """Sentences by end marks; not after known abbreviations, initials or numbers before a small letter."""
    text = text.strip()
    return 1 + sum(_ends_sentence(text, m) for m in BREAK.finditer(text)) if text else 0


#: Word tokens: quotes, marks and contractions stand alone; a final full stop leaves its word. Each pattern
#: comes with strings of which every match holds one (after lower() for the last three), so that it is tried only where it can match.
SPLITS = [
    (('"',), re.compile(r'^"'), "`` "),
    (('"',), re.compile(r'([ (\[{<])"'), r"\1 `` "),
    ((",", ":"), re.compile(r"([:,])([^\d])"), r" \1 \2"),
    ((",", ":"), re.compile(r"([:,])$"), r" \1 "),
    (("...",), re.compile(r"\.\.\."), " ... "),
    (tuple(";@#$%&?!"), re.compile(r"[;@#$%&?!]"), r" \g<0> "),
    ((".",), re.compile(r"(?<=[^\.])(\.)([\])}>\"'”’]*)\s*$"), r" \1 \2"),
    (("' ",), re.compile(r"([^'])' "), r"\1 ' "),
    (tuple("][(){}<>"), re.compile(r"[\]\[(){}<>]"), r" \g<0> "),
    (("--",), re.compile(r"--"), " -- "),
    (('"',), re.compile(r'"'), " '' "),
    (("'",), re.compile(r"([^' ])('[sSmMdD]|'ll|'LL|'re|'RE|'ve|'VE|n't|N'T) "), r"\1 \2 "),
]
RARE_SPLITS = [
    ("annot", re.compile(r"(?i)\b(can)(not)\b"), r" \1 \2 "),
    ("mme", re.compile(r"(?i)\b(gim|lem)(me)\b"), r" \1 \2 "),
    ("nna", re.compile(r"(?i)\b(gon|wan)(na)\b"), r" \1 \2 "),
]


#: Fixed value: characters after an end mark in which the next sentence end is looked for.
AHEAD = 40


def split_sentences(text: str) -> list[str]:
    """Pieces between end marks: after a sentence end, before one within the next AHEAD characters, and after marks that begin a piece."""
    text = text.strip()
    if not text:
        return []
    out, start = [], 0
    marks = [(m.start(), m.end(), _ends_sentence(text, m)) for m in BREAK.finditer(text)]
    ahead = [end for _, end, ends in marks if ends]
    seen = 0
    for at, end, ends in marks:
        seen += ends
        if ends or at == start or (seen < len(ahead) and ahead[seen] < end + AHEAD):
            out.append(text[start:end].strip())
            start = end
    return [*out, text[start:].strip()]


def word_tokens(text: str) -> list[str]:
    """Words and marks, sentence by sentence."""
    out = []
    for x in split_sentences(text):
        for needs, pattern, to in SPLITS:
            for need in needs:
                if need in x:
                    x = pattern.sub(to, f" {x} " if need == "'" else x)
                    break
        small = x.lower()
        for need, pattern, to in RARE_SPLITS:
            if need in small:
                x = pattern.sub(to, x)
        out += x.split()
    return out


#: Frequent short words of some languages, and script ranges of others.
COMMON = {
    "en": "the of and to in is that for it was on are as with by be this or from at an not have you he but they which his we all their can there".split(),
    "fr": "le la les de des du et en un une que qui est pour dans sur par au aux pas ne se ce il elle nous vous avec plus son ou mais".split(),
    "de": "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach bei um".split(),
    "es": "el la los las de que y en un una por con no se su para es al lo como más del pero sus le ya o este sí porque muy".split(),
    "pt": "o a os as de que e do da em um uma para com não por se na no mais dos como mas ao foi das seu sua ou".split(),
    "it": "il lo la i gli le di che e un una per non in con del della è sono come più da al ma si ho anche".split(),
    "vi": "và của là có không được cho một các người những trong đã với này để".split(),
    "sw": "na ya wa kwa ni katika za la kuwa hii kama cha vya lakini pia".split(),
    "fi": "ja on ei se että hän oli mutta ovat kun niin myös tai joka kuin".split(),
    "pl": "i w na z do się nie jest że to o jak ale po od za przez czy tym".split(),
}
SCRIPTS = [
    ("ja", 0x3040, 0x30FF), ("ko", 0xAC00, 0xD7AF), ("th", 0x0E00, 0x0E7F), ("he", 0x0590, 0x05FF), ("bn", 0x0980, 0x09FF), ("pa", 0x0A00, 0x0A7F),
    ("gu", 0x0A80, 0x0AFF), ("ta", 0x0B80, 0x0BFF), ("te", 0x0C00, 0x0C7F), ("kn", 0x0C80, 0x0CFF), ("ml", 0x0D00, 0x0D7F), ("hi", 0x0900, 0x097F),
    ("ar", 0x0600, 0x06FF), ("ru", 0x0400, 0x04FF),
]
MARKS = {"ur": "ٹڈڑےںہ", "fa": "پچژگ", "uk": "іїєґ", "bg": "ъ", "mr": "ळ", "ne": "छ"}


def detect_language(text: str) -> str | None:
    """A language code, or None for a text without letters."""
    letters = [c for c in text if c.isalpha()]
    if not letters:
        return None
    best, hits = None, 0
    for code, lo, hi in SCRIPTS:
        n = sum(lo <= ord(c) <= hi for c in letters)
        if n > hits:
            best, hits = code, n
    if hits > len(letters) / 3:
        if best == "ar":
            return next((k for k in ("ur", "fa") if any(c in MARKS[k] for c in text)), "ar")
        if best == "ru":
            return next((k for k in ("uk", "bg") if any(c in MARKS[k] for c in text.lower())), "ru")
        return best
    tokens = re.findall(r"\w+", text.lower())
    score = {code: sum(t in known for t in tokens) for code, known in ((c, set(w)) for c, w in COMMON.items())}
    extra = {"fr": "éèêàçœ", "de": "äöüß", "es": "ñ¿¡óíá", "pt": "ãõç", "pl": "łąęśż", "fi": "ä", "vi": "ăđơư"}
    for code, chars in extra.items():
        score[code] += sum(text.count(c) for c in chars) * 0.2
    return max(score, key=lambda c: (score[c], c == "en"))


def json_ok(text: str) -> bool:
    """Whether a text, without code fences, is JSON."""
    text = text.strip()
    for fence in ("```json", "```Json", "```JSON", "```"):
        text = text.removeprefix(fence)
    text = text.removesuffix("```").strip()
    try:
        json.loads(text)
    except ValueError:
        return False
    return True

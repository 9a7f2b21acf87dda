"""Native checks against the independent Python checks, and boundaries of each checker."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from verisift.functions import checkers
from verisift.functions import text as T
from verisift.operators import constraints as C
from verisift.operators import verify

PARAMS = {
    "keywords:existence": {"keywords": ["ab", "B"]},
    "keywords:frequency": {"keyword": "a", "frequency": 2, "relation": "at least"},
    "keywords:forbidden_words": {"forbidden_words": ["ab", "b"]},
    "keywords:letter_frequency": {"letter": "A", "let_frequency": 2, "let_relation": "less than"},
    "letters:letter_counting2": {"letter": "b", "let_frequency": 1, "let_relation": "at least"},
    "keywords:word_once": {"keyword": "b"},
    "keywords:word_count_different_numbers": {"keyword": "b", "frequency": 2, "relation": "less than"},
    "keywords:exclude_word_harder": {"keyword": "b"},
    "keywords:key_sentences": {"key_sentences": ["a.", "b!"], "num_sentences": 1},
    "count:count_increment_word": {"keyword1": "a", "keyword2": "b"},
    "count:lowercase_counting": {"N": 2},
    "letters:letter_counting": {"N": 3, "relation": "at least"},
    "length_constraints:number_paragraphs": {"num_paragraphs": 2},
    "length_constraints:number_words": {"num_words": 3, "relation": "less than"},
    "length_constraints:nth_paragraph_first_word": {"num_paragraphs": 2, "nth_paragraph": 2, "first_word": "a"},
    "detectable_content:number_placeholders": {"num_placeholders": 1},
    "detectable_content:postscript": {"postscript_marker": "P.S."},
    "detectable_content:rephrase": {"original_message": "a *b*"},
    "detectable_content:rephrase_paragraph": {"original_paragraph": "a b a", "low": 1, "high": 2},
    "detectable_format:number_bullet_lists": {"num_bullets": 1},
    "detectable_format:number_highlighted_sections": {"num_highlights": 1},
    "detectable_format:multiple_sections": {"section_spliter": "A", "num_sections": 1},
    "combination:repeat_prompt": {"prompt_to_repeat": "a "},
    "startend:end_checker": {"end_phrase": "a?"},
    "copy:copy": {"prompt_to_repeat": "A"},
    "copy:copying_simple": {"prompt_to_repeat": "ab"},
    "copy:copying_multiple": {"prompt_to_repeat": "a", "N": 2},
    "copy:repeat_phrase": {"phrase": "a b a", "small_n": 1},
    "new:copy_span_idx": {"prompt_to_repeat": "xaby", "n_start": 1, "n_end": 3},
    "first_word:first_word_sent": {"first_word": "a"},
    "first_word:first_word_answer": {"first_word": "A"},
    "last_word:last_word_sent": {"last_word": "b"},
    "last_word:last_word_answer": {"last_word": "b"},
    "multi-turn:constrained_start": {"starter": "a"},
    "language:response_language": {"language": "en"},
    "length_constraints:number_sentences": {"num_sentences": 2, "relation": "less than"},
    "change_case:capital_word_frequency": {"capital_frequency": 1, "capital_relation": "at least"},
    "count:counting_composition": {"n_sent": 1, "n_words": 2},
    "keywords:keyword_specific_position": {"keyword": "b", "n": 1, "m": 2},
}
NATIVE = sorted(i for i, c in C.REGISTRY.items() if c.native)
EDGES = [
    "", " ", "\t\n", " ", " ", "a", "A", "b", "é", "😀", "a b", "b a", "ab AB", "a. b!", 'a?"', '"a b"', '"', '""', "***", "a***b", "a *** *** b", "***a***b***", "a\n\nb", "\n\na\n\nb\n\n", "a\n\n\n\nb",
    "[a] [b]", "[a]", "<<a b>>", "<< >>", "<<a b>> <<b a>>", "* a\n- b", "*a*", "**a**", "* *", "******", "a******a", "a******b", "A 1 b A 2", "P.S. a", "p. p. s a", "My answer is yes. ", "Dr. a. U.S. b. 3.5 a... b. Ph.D. x",
    "a-b", "a.-b.", "a b\x1cb", "aba abba", "c d", "'a, b", '"a', "a, b.", "a b a", "a a a", "a *x*", "I am. He is.", "A.B. He ran.", "Acme Inc. He ran. Inc. a", "see x.com. or a.b.c. d", "a\r\nb", "a\x85b",
]


def run_native(spark, ids, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    cols = [C.REGISTRY[c].follows(F.col("x"), **{k: F.lit(v) for k, v in PARAMS.get(c, {}).items()}).alias(c.replace(":", "__")) for c in ids]
    rows = df.select("i", *cols).orderBy("i").collect()
    return {c: [r[c.replace(":", "__")] for r in rows] for c in ids}


def test_every_constraint_has_both_forms():
    assert set(C.REGISTRY) == set(checkers.CHECKS)
    assert len(C.REGISTERED) == 54


def test_native_equals_python_on_edges(spark):
    got = run_native(spark, NATIVE, EDGES)
    bad = [(c, t, g) for c in NATIVE for t, g in zip(EDGES, got[c], strict=True) if g != checkers.check(c, t, PARAMS.get(c))]
    assert not bad, bad[:10]


TEXTS = st.lists(st.text(alphabet='ab AB.!?*-"\'\n[]<>1 é,', max_size=30), min_size=40, max_size=40)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=TEXTS)
def test_native_equals_python_on_random_texts(spark, texts):
    got = run_native(spark, NATIVE, texts)
    bad = [(c, t, g) for c in NATIVE for t, g in zip(texts, got[c], strict=True) if g != checkers.check(c, t, PARAMS.get(c))]
    assert not bad, bad[:10]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.text(alphabet='aA.!?"” \nDrIncHe15com', max_size=40), min_size=60, max_size=60))
def test_sentences_equal_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    rows = df.select("i", T.sentences(F.col("x")).alias("s")).orderBy("i").collect()
    bad = [(t, r["s"], checkers.sentences(t)) for t, r in zip(texts, rows, strict=True) if r["s"] != checkers.sentences(t)]
    assert not bad, bad[:3]


@pytest.mark.parametrize(
    ("id_", "params", "good", "bad"),
    [
        ("length_constraints:number_words", {"num_words": 3, "relation": "at least"}, "a b c", "a b"),
        ("length_constraints:number_words", {"num_words": 3, "relation": "less than"}, "a b", "a b c"),
        ("detectable_format:json_format", {}, '```json\n{"a": [1, NaN]}```', '{"a": 1} x'),
        ("length_constraints:number_sentences", {"num_sentences": 2, "relation": "at least"}, "Dr. Smith left. He ran.", "Dr. Smith left."),
        ("change_case:english_capital", {}, "THE CAT AND THE DOG", "The cat and the dog"),
        ("change_case:english_lowercase", {}, "the cat and the dog", "The cat"),
        ("change_case:capital_word_frequency", {"capital_frequency": 2, "capital_relation": "at least"}, "NASA and ESA", "NASA only"),
        ("count:count_unique", {}, "one two three.", "one two one"),
        ("keywords:start_end", {}, "echo and echo", "echo and echo."),
        ("keywords:keyword_specific_position", {"keyword": "cat", "n": 2, "m": 2}, "Hi there. The cat sat.", "The cat sat."),
        ("language:response_language", {"language": "de"}, "der Hund und die Katze sind nicht hier", "the dog and the cat are not here"),
        ("count:counting_composition", {"n_sent": 1, "n_words": 3}, "One two. *** Three four. *** Five six.", "One two. *** Three four."),
        ("new:copy_span_idx", {"prompt_to_repeat": "abcdef", "n_start": 0, "n_end": 2}, "AB", "abc"),
        ("copy:repeat_phrase", {"phrase": "a b c d", "small_n": 2}, "a x c d, a b y d", "a b c d, a b c d"),
    ],
)
def test_boundaries(id_, params, good, bad):
    assert checkers.check(id_, good, params) is True
    assert checkers.check(id_, bad, params) is False


def test_bad_input_is_false_not_an_error():
    assert checkers.check("no:such", "a", {}) is False
    assert checkers.check("keywords:frequency", "a", {"keyword": "(", "frequency": 1, "relation": "at least"}) is False
    assert checkers.check("keywords:frequency", "a", {"keyword": "a", "frequency": 1, "relation": "about"}) is False
    assert checkers.check("keywords:frequency", "a", None) is False
    assert checkers.check("last_word:last_word_answer", "  ", {"last_word": "a"}) is False
    assert checkers.check_json("punctuation:no_comma", None, None) is False
    assert checkers.check_json("punctuation:no_comma", "a", "{bad") is False


def test_verify_rows_with_json_parameters(spark):
    gt = json.dumps([{"instruction_id": ["punctuation:no_comma", "keywords:existence"], "kwargs": [None, {"keywords": ["("]}]}, {"instruction_id": ["count:lowercase_counting"], "kwargs": [{"N": 1}]}])
    rows = [("k1", "a b", gt), ("k2", "A", gt), ("k3", "x", "[]"), ("k4", "x", "no json"), ("k5", None, gt)]
    df = spark.createDataFrame(rows, "key string, response string, ground_truth string")
    got = {r["key"]: r for r in verify.verify(df, "key", "response").collect()}
    assert got["k1"]["individual_results"] == [True, False, False]
    assert got["k2"]["individual_results"] == [True, False, True]
    assert got["k3"]["verification_passed"] and got["k3"]["individual_results"] == []
    assert got["k4"]["verification_passed"]
    assert got["k5"]["individual_results"] == [False, False, False]
    stats = verify.verification_stats(verify.verify(df, "key", "response")).first()
    assert stats["total_constraints"] == 9 and stats["passed_constraints"] == 3
    empty = verify.verification_stats(verify.verify(df.limit(0), "key", "response")).first()
    assert empty["example_accuracy"] == 0.0 and empty["total"] == 0


def test_sql_function(spark):
    verify.register(spark)
    row = spark.sql("SELECT check_constraint('a b', 'punctuation:no_comma', NULL) AS a, check_constraint('a, b', 'punctuation:no_comma', '{}') AS b").first()
    assert row["a"] is True and row["b"] is False

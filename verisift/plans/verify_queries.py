"""One query for each constraint: doc_id and whether the (derived) response follows it.

The tables' prose has no markup, so most responses are derived from the text by an
expression that Spark and DuckDB both run.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verisift.operators import verify
from verisift.operators.constraints import REGISTRY
from verisift.plans import oracles as O


@dataclass
class Case:
    id: str
    params: dict = field(default_factory=dict)
    response: str = "text"
    test: str | None = None
    let: str = "NULL"
    sql_params: dict = field(default_factory=dict)

    @property
    def name(self) -> str:
        return "verify_" + self.id.replace(":", "_").replace("-", "_")

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
        docs = docs.select("doc_id", F.expr(self.response).alias("x"), *[F.expr(v).alias(f"p_{k}") for k, v in self.sql_params.items()])
        if REGISTRY[self.id].native:
            ok = REGISTRY[self.id].follows(F.col("x"), **self.params, **{k: F.col(f"p_{k}") for k in self.sql_params})
            return docs.select("doc_id", ok.alias("followed"))
        return docs.select("doc_id", verify.check_with_python(F.lit(self.id), F.col("x"), F.lit(json.dumps(self.params))).alias("followed"))

    @property
    def sql(self) -> str:
        return f"SELECT doc_id, coalesce(({self.test}), false) AS followed FROM (SELECT *, {self.let} AS p FROM (SELECT doc_id, text, {self.response} AS x FROM documents))"


STAR_LINE, DASH_LINE, SECTION = r"(?m)^\s*\*[^\*].*$", r"(?m)^\s*-.*$", r"\s?Section\s?\d+\s?"
EVEN = "CASE WHEN doc_id % 2 = 0 THEN {} ELSE {} END"
NL = "concat('.', chr(10), chr(10))"
TOKENS = f"regexp_extract_all(x, '{O.WORD}+')"
STARS = "string_split_regex(x, '\\s?\\*\\*\\*\\s?')"
GOLD = "['The', 'early', 'bird', 'catches', 'the', 'worm']"
#: Words that a text shares with the paragraph, each as often as in both.
SHARED = "list_sum(list_transform([struct_pack(w := 'the', n := 2), struct_pack(w := 'cat', n := 1), struct_pack(w := 'is', n := 1), struct_pack(w := 'on', n := 1), struct_pack(w := 'mat', n := 1), struct_pack(w := 'and', n := 1), struct_pack(w := 'it', n := 1), struct_pack(w := 'was', n := 1), struct_pack(w := 'there', n := 1)], lambda o: least(o.n, len(list_filter(p, lambda t: t = o.w))))) BETWEEN 4 AND 6"
COPIED = EVEN.format("concat(' ', text, ' ')", "substr(text, 2)")
SAME = f"lower({O.strip('x')}) = lower({O.strip('text')})"

CASES = [
    Case("keywords:existence", {"keywords": ["the", "st"]}, test="regexp_matches(x, '(?i)the') AND regexp_matches(x, '(?i)st')"),
    Case("keywords:frequency", {"keyword": "the", "frequency": 3, "relation": "at least"}, test=f"{O.count('x', '(?i)the')} >= 3"),
    Case("keywords:forbidden_words", {"forbidden_words": ["clown", "which"]}, test=f"NOT list_has_any(list_transform({TOKENS}, lambda t: lower(t)), ['clown', 'which'])"),
    Case("keywords:letter_frequency", {"letter": "Q", "let_frequency": 5, "let_relation": "less than"}, test="length(lower(x)) - length(replace(lower(x), 'q', '')) < 5"),
    Case("letters:letter_counting2", {"letter": "z", "let_frequency": 3, "let_relation": "at least"}, test="length(lower(x)) - length(replace(lower(x), 'z', '')) >= 3"),
    Case("keywords:word_once", {"keyword": "from"}, test=f"{O.count('x', '(?i)from')} = 1"),
    Case("keywords:word_count_different_numbers", {"keyword": "by", "frequency": 2, "relation": "less than"}, test=f"{O.count('x', '(?i)by')} < 2"),
    Case("keywords:exclude_word_harder", {"keyword": "that"}, test="NOT contains(x, ' that ')"),
    Case("keywords:no_adjacent_consecutive", {}, "text", "len(list_filter(p, lambda v, i: i < len(p) AND unicode(p[i + 1]) - unicode(v) = 1)) = 0", O.words("lower(x)")),
    Case("keywords:palindrome", {}, "text", "len(list_filter(p, lambda v: v = reverse(v))) > 0", O.words("x")),
    Case("count:count_increment_word", {"keyword1": "was", "keyword2": "with"}, test=f"{O.count('x', '(?i)was')} = 1 AND {O.count('x', '(?i)with')} = 2"),
    Case("length_constraints:number_paragraphs", {"num_paragraphs": 3}, "replace(text, '. ', '. *** ')", f"{O.paragraphs('p')} = 3", STARS),
    Case("paragraphs:paragraphs", {}, "replace(text, '. ', ' *** ')", f"{O.paragraphs('p')} = 2", STARS),
    Case("paragraphs:paragraphs2", {}, f"replace(text, '. ', {NL})", f"{O.paragraphs('p')} = 2", "string_split(x, chr(10) || chr(10))"),
    Case("length_constraints:number_words", {"num_words": 200, "relation": "less than"}, test=f"len({TOKENS}) < 200"),
    Case("length_constraints:nth_paragraph_first_word", {"num_paragraphs": 2, "nth_paragraph": 2, "first_word": "the"}, f"concat(text, chr(10), chr(10), {EVEN.format(chr(39) + 'The, end' + chr(39), 'text')})", f"len(list_filter(p, lambda s: NOT {O.blank('s')})) = 2 AND NOT {O.blank('p[2]')} AND lower(regexp_extract(regexp_replace(regexp_replace({O.words('p[2]')}[1], '^''+', ''), '^\"+', ''), '^[^.,?!''\"]*')) = 'the'", "string_split(x, chr(10) || chr(10))"),
    Case("count:lowercase_counting", {"N": 200}, test=f"len(list_filter({TOKENS}, lambda t: regexp_matches(t, '^[a-z]+$'))) <= 200"),
    Case("letters:letter_counting", {"N": 500, "relation": "at least"}, test=f"{O.count('x', '[a-zA-Z]')} >= 500"),
    Case("detectable_content:number_placeholders", {"num_placeholders": 2}, "replace(replace(text, ', ', ' ['), '. ', '] ')", f"{O.count('x', chr(92) + '[.*?' + chr(92) + ']')} >= 2"),
    Case("detectable_content:postscript", {"postscript_marker": "P.S."}, EVEN.format("concat(text, chr(10), 'P.S. bye')", "text"), r"regexp_matches(lower(x), '\s*p\.\s?s\..*')"),
    Case("detectable_format:number_bullet_lists", {"num_bullets": 4}, "concat('* ', replace(text, '. ', concat('.', chr(10), '* ')))", f"{O.count('x', STAR_LINE)} + {O.count('x', DASH_LINE)} = 4"),
    Case("detectable_format:constrained_response", {}, EVEN.format("concat(text, ' My answer is no.')", "text"), "contains(x, 'My answer is yes.') OR contains(x, 'My answer is no.') OR contains(x, 'My answer is maybe.')"),
    Case("detectable_format:number_highlighted_sections", {"num_highlights": 2}, "replace(text, ', ', '* *')", rf"len(list_filter(regexp_extract_all(x, '\*[^\n\*]*\*'), lambda h: NOT {O.blank('trim(h, chr(42))')})) + len(list_filter(regexp_extract_all(x, '\*\*[^\n\*]*\*\*'), lambda h: NOT {O.blank('substr(h, 3, length(h) - 4)')})) >= 2"),
    Case("detectable_format:multiple_sections", {"section_spliter": "Section", "num_sections": 3}, "replace(text, '. ', ' Section 1 ')", f"{O.count('x', SECTION)} >= 3"),
    Case("detectable_format:title", {}, EVEN.format("concat(text, ' <<a title>>')", "concat(text, ' << >>')"), rf"len(list_filter(regexp_extract_all(x, '<<[^\n]+>>'), lambda t: NOT {O.blank('rtrim(ltrim(t, chr(60)), chr(62))')})) > 0"),
    Case("detectable_format:square_brackets", {}, "concat('[', replace(text, ' ', '] ['), ']')", "len(list_filter(p, lambda w: NOT (starts_with(w, '[') AND ends_with(w, ']')))) = 0", O.words("x")),
    Case("detectable_format:bigram_wrapping", {}, "concat('<<', replace(text, ' ', '>> <<'), '>>')", "len(list_filter(p, lambda w, i: (i % 2 = 1 AND i < len(p) AND NOT starts_with(w, '<<')) OR (i % 2 = 0 AND NOT ends_with(w, '>>')))) = 0", O.words("x")),
    Case("combination:two_responses", {}, "replace(text, '. ', '******')", f"len(list_filter(p, lambda s, i: i > 1 AND i < len(p) AND {O.blank('s')})) = 0 AND len(list_filter(p, lambda s: NOT {O.blank('s')})) = 2 AND {O.strip(f'list_filter(p, lambda s: NOT {O.blank(chr(115))})[1]')} <> {O.strip(f'list_filter(p, lambda s: NOT {O.blank(chr(115))})[2]')}", "string_split(x, '******')"),
    Case("startend:end_checker", {"end_phrase": "Any other questions?"}, EVEN.format("concat(text, ' Any other questions?  ')", "concat(text, '.')"), f"ends_with(lower(trim({O.strip('x')}, chr(34))), 'any other questions?')"),
    Case("startend:quotation", {}, EVEN.format("concat(chr(34), text, chr(34))", "text"), f"length({O.strip('x')}) > 1 AND starts_with({O.strip('x')}, chr(34)) AND ends_with({O.strip('x')}, chr(34))"),
    Case("punctuation:no_comma", test="NOT contains(x, ',')"),
    Case("punctuation:punctuation_dot", test="NOT contains(x, '.')"),
    Case("punctuation:punctuation_exclamation", test="NOT contains(x, '!')"),
    Case("first_word:first_word_answer", {"first_word": "the"}, test="lower(p[1]) = 'the'", let=O.words("x")),
    Case("last_word:last_word_answer", {"last_word": "the"}, test=f"{O.bare('p[len(p)]')} = 'the'", let=O.words("x")),
    Case("combination:repeat_prompt", {}, EVEN.format("concat(text, ' and more')", "concat('so ', text)"), f"starts_with(lower({O.strip('x')}), lower({O.strip('text')}))", sql_params={"prompt_to_repeat": "text"}),
    Case("copy:copy", {}, COPIED, SAME, sql_params={"prompt_to_repeat": "text"}),
    Case("copy:copying_simple", {}, COPIED, SAME, sql_params={"prompt_to_repeat": "text"}),
    Case("copy:copying_multiple", {"N": 2}, f"concat(text, '******', {EVEN.format('text', 'substr(text, 2)')})", f"len(p) = 2 AND len(list_filter(p, lambda s: lower({O.strip('s')}) <> lower({O.strip('text')}))) = 0", "string_split(x, '******')", sql_params={"prompt_to_repeat": "text"}),
    Case("new:copy_span_idx", {"n_start": 3, "n_end": 12}, EVEN.format("substr(text, 4, 9)", "substr(text, 4, 10)"), f"lower({O.strip('x')}) = lower({O.strip('substr(text, 4, 9)')})", sql_params={"prompt_to_repeat": "text"}),
    Case("copy:repeat_phrase", {"phrase": "The early bird catches the worm", "small_n": 2}, "concat(text, CASE doc_id % 3 WHEN 0 THEN ' The early fish catches the worm. The late bird catches the worm' WHEN 1 THEN ' The early bird catches the worm and The early bird catches the worm' ELSE '' END)", f"len(p) = 2 AND len(list_filter(p, lambda f: len({O.words('f')}) <> 6 OR len(list_filter({O.words('f')}, lambda v, i: v <> {GOLD}[i])) > 1)) = 0 AND len(list_filter({O.words('p[len(p)]')}, lambda v, i: v <> {GOLD}[i])) = 1", "regexp_extract_all(x, 'The .*? worm')"),
    Case("detectable_format:json_format", {}, EVEN.format("concat('{\"a\": ', cast(doc_id AS STRING), '}')", "text"), "json_valid(x)"),
    # checks without a counterpart in SQL
    Case("detectable_format:sentence_hyphens", {}, "replace(text, '. ', '.-')"),
    Case("first_word:first_word_sent", {"first_word": "the"}),
    Case("last_word:last_word_sent", {"last_word": "the"}),
    Case("language:response_language", {"language": "en"}),
    Case("length_constraints:number_sentences", {"num_sentences": 10, "relation": "less than"}),
    Case("change_case:capital_word_frequency", {"capital_frequency": 2, "capital_relation": "at least"}),
    Case("change_case:english_capital", {}, "upper(text)"),
    Case("change_case:english_lowercase", {}, "lower(text)"),
    Case("count:counting_composition", {"n_sent": 2, "n_words": 3}, "concat('A b. C d.', ' *** ', text, ' *** ', 'I j. K l.')"),
    Case("count:count_unique", {}, "text"),
    Case("keywords:keyword_specific_position", {"keyword": "the", "n": 1, "m": 2}),
    Case("keywords:start_end", {}),
    Case("detectable_content:rephrase_paragraph", {"original_paragraph": "the cat is on the mat and it was there", "low": 4, "high": 6}, test=SHARED, let=f"list_transform({TOKENS}, lambda t: lower(t))"),
    Case("keywords:key_sentences", {"key_sentences": ["Of.", "The."], "num_sentences": 1}),
    Case("multi-turn:constrained_start", {"starter": "I think"}, EVEN.format("concat('I think ', text)", "text"), "regexp_matches(x, '(?m)^\\s*I think.*$')"),
    Case("detectable_content:rephrase", {"original_message": "a *b* c"}, EVEN.format("'a *x* c'", "text"), r"regexp_matches(x, '\*.*\*') AND regexp_replace(x, '\*.*\*', '', 'g') = 'a  c'"),
]

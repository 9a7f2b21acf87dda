"""The learned parts of the secret and personal-data scans against brute force, and their edge cases."""

import collections
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from verisift.llm import pii, secrets, spans

CORPUS = (
    [f"contact: user{i}@mail.example.com now" for i in range(12)]
    + [f"contact: member-{i}-x now, see account member-{i}-x or account=member-{i}-x (account 'member-{i}-x')" for i in range(4)]
    + ["my account ZX-990017-Q is open", "an account 77-A", 'with "account":   "QQ-55-QQ77"', "the member-1-x list", "plain words only", "the 12345678 of", "account", "", None]
    + ["contact: " + "A1" * 60 + ".", "dial +49 (0) 30-1234567 or dial +49 (0) 30-7654321, dial +1 (743) 555-3824; dial 555123, dial 666-1234"]
)


def words(t):
    return re.findall(r"\w+", t.lower())


def patterns(lead):
    w = words(lead)[-2:]
    return [w[-1], " ".join(w)][: len(w)]


def brute_context(texts, base, min_seeds=3, min_confidence=0.5, rounds=5):
    """Spans that the accepted patterns find, by plain loops."""
    found, edges, total = [], collections.defaultdict(lambda: [0, False]), collections.Counter()
    for t, own in zip(texts, base):
        t = t or ""
        ws = words(t)
        total.update(ws)
        total.update(f"{a} {b}" for a, b in zip(ws, ws[1:]))
        fresh = []
        for m in re.finditer(r"(?<![\w@.+#/-])[^\W_](?:[\w@.+#/-])*|(?<![\w@.+#/-])[@._+#/-][\w@.+#/-]*", t):
            x = m[0].rstrip("@._+#/-")
            if len(x) >= 6 and re.search("[0-9@]", x) and not any(a < m.start() + len(x) and m.start() < b for _, a, b in own):
                fresh.append((m.start(), m.start() + len(x), x, patterns(t[: m.start()])))
        for _, a, b in own:
            for p in patterns(t[:a]):
                e = edges[p, t[a:b]]
                e[0], e[1] = e[0] + 1, True
        for _, _, x, ps in fresh:
            for p in ps:
                edges[p, x][0] += 1
        found.append(fresh)
    n_instances = collections.Counter(p for p, _ in edges)
    scores, accepted = {}, None
    for _ in range(rounds):
        score = lambda x, seed: 1.0 if seed else scores.get(x, 0.0)
        mass, support = collections.Counter(), collections.Counter()
        for (p, x), (n, seed) in edges.items():
            mass[p] += n * score(x, seed)
            support[p] += score(x, seed) >= 0.5
        new = {p: mass[p] / (total[p] + 1) for p in mass if n_instances[p] >= min_seeds and support[p] >= min_seeds and mass[p] / (total[p] + 1) >= min_confidence}
        same, accepted = accepted is not None and set(new) == set(accepted), new
        if same:
            break
        scores = {}
        for (p, x), (_, seed) in edges.items():
            if p in accepted and not seed:
                scores[x] = 1 - (1 - scores.get(x, 0.0)) * max(1 - min(accepted[p], 1.0), 1e-9)
    return [sorted((a, b) for a, b, _, ps in fresh if any(p in accepted for p in ps)) for fresh in found], set(accepted)


def test_bootstrapping_equals_brute_force(spark):
    rows = list(enumerate(CORPUS)) + [(3, CORPUS[3]), (None, CORPUS[3])]
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, base string, seeds int, spans string").repartition(3)
    got = pii.scan(df).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    base = [[(s["rank"], s["start"], s["end"]) for s in by_id[i]["base"]] for i, _ in rows]
    want, accepted = brute_context([t for _, t in rows], base)
    for (i, _), w in zip(rows, want):
        assert [(s["start"], s["end"]) for s in by_id[i]["spans"] if s["rank"] == 4] == w, i
    # two hops: e-mails give contact, members after contact give account, account gives what was never seen elsewhere
    assert {"contact", "account", "dial"} <= accepted and "the" not in accepted
    flat = {CORPUS[i][a:b] for (i, _), w in zip(rows, want) if i is not None for a, b in w}
    assert {"ZX-990017-Q", "QQ-55-QQ77", "A1" * 60, "666-1234"} <= flat


def test_patterns_are_counted_alike_by_broadcast_and_by_shuffle(spark):
    found = spark.createDataFrame([(t or "",) for t in CORPUS], "_text string")
    wanted = spark.createDataFrame([("account",), ("see account",), ("now see",), ("nothing",)], "pattern string")
    few, many = ({r["pattern"]: r["total"] for r in pii.pattern_totals(found, wanted, most).collect()} for most in (100, 0))
    assert few == many == {"account": 16, "see account": 4, "now see": 4}


def test_many_spans_in_one_document_are_redacted_in_time(spark):
    n = 20_000
    text = "mail: user1@mail.com code abc-1234 " * n
    start = time.time()
    out = pii.redact(spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string")).collect()
    assert time.time() - start < 60
    # few distinct seeds: no pattern is learned
    assert {r["doc_id"]: r["text"] for r in out} == {1: "mail: [EMAIL] code abc-1234 " * n, 2: "x"}


def test_overlapping_spans_are_redacted_as_one(spark):
    kind = "array<struct<start:int,rank:int,end:int>>"
    df = spark.createDataFrame([("é😀abcdefghij" * 300, [(2, 0, 6), (4, 1, 9), (9, 1, 10), (3500, 0, 3599)]), ("abc", []), ("abc", [(0, 1, 3)])], f"t string, s {kind}")
    got = [r[0] for r in df.select(spans.redacted(F.col("t"), F.col("s"), ["p", "q"])).collect()]
    t = "é😀abcdefghij" * 300
    assert got == [t[:2] + "[P][Q]" + t[10:3500] + "[P]" + t[3599:], "abc", "[Q]"]


ALPHABET = secrets.ALPHABET


def brute_ratio(s, model):
    return sum(model[len(ALPHABET) * ALPHABET.index(a) + ALPHABET.index(b)] for a, b in zip(s, s[1:]))


def test_markov_spans_equal_brute_force(spark):
    rows = [
        "see q7Xb9ZkP2vR4tLw8HsYd3NfGm and qzxkvwjpqfxgzkqjvxwzqkxjvqpzwkfx", "0123456789012345678901234567890", "-" * 60 + "=" * 60 + "ab" * 40, "word " * 50000 + "Zx8Kq2Lw9Vb4Nm7Jt5Rc3Yp6Hd1Gs" + " word" * 50000,
        "token=aB3dE5gH7jK9mN1pQ3sT5vW7yZ2xC4 aB3dE5gH7jK9mN1pQ3sT5vW7yZ2xC4", "the-quick-settings-manager-reads-every", "", None, "", "aB3dE5gH7jK9mN1pQ3sT5vW7yZ2xC4",
    ]
    data = list(enumerate(rows)) + [(0, rows[0]), (None, rows[0])]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in data], "doc_id long, text string, base int, spans string").repartition(3)
    ordinary = "the quick settings manager reads every configuration value before starting another worker process".split()
    corpus = spark.createDataFrame([(i, " ".join(random.Random(i).sample(ordinary, len(ordinary)))) for i in range(300)], "doc_id long, text string")
    model = secrets.train(secrets.sample_identifiers(corpus, "text"), secrets.sample_random(corpus, 500))
    got = secrets.scan(df, model=model).collect()
    assert len(got) == len(data)
    hits = 0
    for r in got:
        t, base = r["text"], [(s["start"], s["end"]) for s in r["base"]]
        want = []
        for m in re.finditer(r"(?<![^\W_])(?<![+/_=-])[A-Za-z0-9+/_=-]{20,}(?![^\W_])", t):
            s = m[0]
            if not any(a < m.end() and m.start() < b for a, b in base) and len(set(s)) >= 8 and re.search("[A-Za-z]", s) and brute_ratio(s, model) >= secrets.MIN_RATIO:
                want.append((m.start(), m.end()))
        assert [(s["start"], s["end"]) for s in r["spans"] if s["rank"] == 3] == want, t[:50]
        hits += len(want)
    assert hits == 9


def test_ordinary_identifiers_come_from_whole_and_distinct_texts(spark):
    text = " ".join(f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100 % 10]}" for i in range(1000)) + " " + "long" * 30
    df = spark.createDataFrame([(i, text) for i in range(30)], "doc_id long, text string")
    words = {r["s"] for r in secrets.sample_identifiers(df, "text").collect()}
    once = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert secrets.sample_identifiers(df, "text").count() == secrets.sample_identifiers(once, "text").count()
    assert any("long" * 30 in w for w in words) and any(w.startswith("jtd") for w in words)


def test_log_ratios_are_smoothed(spark):
    empty = spark.createDataFrame([], "s string")
    assert all(math.isclose(x, 0.0) for x in secrets.train(empty, empty))


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000])
def test_running_sums(spark, n):
    values = F.transform(F.sequence(F.lit(1), F.lit(n + 1)), lambda x: x)
    row = spark.range(1).select(spans.running(values, F.lit(0), lambda a, x: a + x, lambda upto: F.transform(F.sequence(F.lit(-1), F.lit(n)), upto)).alias("s")).first()
    assert row["s"] == [k * (k + 1) // 2 for k in range(n + 2)]

"""Truncation: the censored fit, the evidence of endings, and accuracy on texts cut on purpose."""

import math
import random
from collections import Counter, defaultdict

import numpy as np

from reckon.llm import truncation as tr


def run(spark, docs):
    df = spark.createDataFrame([(*d, 0, "h") for d in docs], "doc long, source string, text string, cell int, h string")
    return tr.Truncation(df, id="doc", source="source", text="text")


def test_finds_what_was_cut(spark, writer):
    rng, docs, cut = random.Random(1), [], set()
    for i in range(3000):
        source, limit = (("form", 400) if i % 3 else ("mail", None))
        text = writer(i, int(rng.lognormvariate(5.5, 0.5)))
        if limit and len(text) > limit:
            text = text[:limit]
            cut.add(i)
        elif rng.random() < 0.03 and len(text) > 80:
            text = text[: rng.randint(40, len(text) - 20)]
            if text[-1] not in ".?!":
                cut.add(i)
        docs.append((i, source, text))
    first = next(d for d in docs if d[0] in cut)
    docs += [(5000, "mail", first[2]), (5001, None, first[2]), (5002, "form", None), (5003, None, ""), (5004, "mail", "x" * 500_000 + ".")]
    t = run(spark, docs)
    found = {r.id for r in t.found().collect()}
    cut |= {5000, 5001}
    assert len(found & cut) >= 0.9 * len(cut) and len(found - cut) <= 0.05 * len(cut)
    assert {5000, 5001} <= found and not {5002, 5003, 5004} & found
    rates = {r.source: r for r in t.rates().collect()}
    assert rates["form"].cut > rates["mail"].cut and sum(r.documents for r in rates.values()) == len(docs) - 2
    limits = {(r.scope, r.unit, r.limit) for r in t.cells.collect()}
    assert ("form", "chars", 400) in limits and not any(s == "mail" for s, _, _ in limits)


def test_empty_table(spark):
    t = run(spark, [])
    assert t.found().count() == 0 and t.rates().count() == 0


def test_censored_fit_recovers_the_distribution():
    rng = np.random.default_rng(3)
    x = rng.normal(5.0, 0.6, 20_000)
    c = 5.4
    mu, sd, _ = tr.fit_censored(x[x < c], np.ones((x < c).sum()), np.array([c]), np.array([float((x >= c).sum())]))
    assert abs(mu - 5.0) < 0.02 and abs(sd - 0.6) < 0.02


def test_limits_in_characters_and_bytes():
    rng = np.random.default_rng(4)
    n = np.minimum(np.exp(rng.normal(6, 0.4, 5000)).astype(int), 500)
    extra = rng.integers(0, 30, 5000)
    hist = lambda v: tuple(map(np.array, np.unique(v, return_counts=True)))
    assert tr.candidate_limits({"chars": hist(n), "bytes": hist(n + extra)}) == [("chars", 500)]
    assert tr.candidate_limits({"chars": hist(n - extra), "bytes": hist(n)}) == [("bytes", 500)]
    free = np.exp(rng.normal(6, 0.4, 5000)).astype(int)
    assert tr.candidate_limits({"chars": hist(free), "bytes": hist(free + extra)}) == []


def test_marks_groups_and_shapes():
    assert tr.marked("the en…") == ("the en", tr.ELLIPSIS)
    assert tr.marked("gepr\ufffd") == ("gepr", tr.BROKEN)
    assert tr.marked("paid (see note 4)") == ("paid (see note 4)", tr.PLAIN)
    assert tr.last_group("the end\n[message 12 clipped]  ") == ("the end", "[message 99 clipped]")
    assert tr.last_group("the en... (rest not sent)") == ("the en", "(rest not sent)")
    assert tr.last_group("no one c\n--- cut by relay ---") == ("no one c", "--- cut by relay ---")
    assert all(tr.last_group(t) is None for t in ("", "plain.", "a (b) c)", "a) b", "--", "[alone]", "a\n-- signed", "x ---"))
    assert tr.last_group("(" * 100_000 + ")")[1] == "()" and tr.last_group("- " * 100_000 + "--") is None
    assert [tr.shape(w) for w in ("word", "123", "ch_3Ab9", "x9")] == ["word", "999", "ch_X4", "_X2"]
    assert tr.chain("it was paid on 12") == tr.chain("it was paid on 99") != tr.chain("it was paid on 123")
    assert all(tr.last_word(t) == tr.chain(t)[1] for t in ("it was paid", "a (b", "12", "one, two,", "x" * 500, "on 2026-01-02", "ch_3Ab9", "l'an"))
    assert all(1 <= p < 50 for d in range(50) for p in tr.places("x" * 50, d * 7919**5))
    assert math.isclose(float(tr.normal_tail(np.array([0.0]))[0]), 0.5)


def test_a_notice_is_told_by_what_stands_before_it(spark, writer):
    rng, docs, cut = random.Random(11), [], set()
    for i in range(2500):
        text = writer(i, int(rng.lognormvariate(5.5, 0.4)))
        if i % 60 == 0:
            text = text[: rng.randint(60, len(text) - 5)] + "\n[message clipped]"
            cut.add(i)
        elif i % 60 == 1:
            text = text.rstrip(".?!") + " (see note %d)" % (i % 7)
        docs.append((i, "mail", text))
    probes = ["The account was closed (cut short by agreement)", "It was paid [nothing missing here]", "Order is final (no items missing)"]
    docs += [(9000 + i, "mail", writer(9000 + i, 200) + " " + p) for i, p in enumerate(probes)]
    found = {r.id for r in run(spark, docs).found().collect()}
    assert len(found & cut) >= 0.9 * len(cut)
    assert len({i for i, _, t in docs if t.endswith(")") or i >= 9000} & found) <= 1


def test_sampled_and_whole_fit_agree(spark, writer):
    rng, docs, cut = random.Random(12), [], set()
    for i in range(3000):
        text = writer(i, int(rng.lognormvariate(5.4, 0.4)))
        if rng.random() < 0.05:
            text = text[: rng.randint(40, len(text) - 20)]
            if text[-1] not in ".?!":
                cut.add(i)
        docs.append((i, "mail" if i % 3 else "form", text))
    df = spark.createDataFrame(docs, "doc long, source string, text string")
    for sample in (600, 60_000):
        found = {r.id for r in tr.Truncation(df, id="doc", source="source", text="text", sample=sample).found().collect()}
        assert len(found & cut) >= 0.95 * len(cut) and len(found - cut) <= 0.05 * len(cut)


def plain_end(text):
    """The text up to a whole word, without what would tell its end."""
    return text.rstrip(".?!")


def test_limit_of_a_small_source_among_many_texts(spark, writer):
    rng = random.Random(5)
    docs = [(i, "mail", plain_end(writer(i, int(rng.lognormvariate(5.5, 0.3))))) for i in range(4000)]
    docs += [(5000 + i, "small", plain_end(writer(5000 + i, rng.randint(60, 200)))) for i in range(50)]
    cut = set(range(6000, 6010))
    docs += [(i, "small", writer(i, 330)[:260]) for i in cut]
    docs += [(7000, None, writer(7000, 330)[:260]), (7001, None, plain_end(writer(7001, 150)))]
    t = run(spark, docs)
    cells = {(r.scope, r.unit, r.limit) for r in t.cells.collect()}
    assert {("small", "chars", 260), (tr.ALL, "chars", 260)} <= cells
    found = {r.id for r in t.found().collect()}
    assert len(found & cut) >= 9
    assert len([i for i in found if 5000 <= i < 6000]) <= 2 and 7001 not in found


def test_limits_of_other_texts_in_the_other_unit_stay():
    rng = np.random.default_rng(6)
    n = np.exp(rng.normal(6, 0.4, 5000)).astype(int)
    hist = lambda v: tuple(map(np.array, np.unique(v, return_counts=True)))
    chars = np.concatenate([np.minimum(n, 500), rng.integers(20, 400, 300)])
    size = np.concatenate([np.minimum(n, 500) + rng.integers(0, 400, 5000), np.full(300, 1200)])
    h = {"chars": hist(chars), "bytes": hist(size)}
    assert tr.candidate_limits(h) == [("chars", 500)]
    apart = {(int(c), int(b)): 1 for c, b in zip(chars, size) if c == 500}
    assert tr.candidate_limits(h, apart) == [("chars", 500), ("bytes", 1200)]
    assert tr.candidate_limits(h, {(500, 1200): 300}) == [("chars", 500)]


def test_every_place_of_every_text_is_counted(spark, writer):
    odd = ["  two  blanks\tand a tab ", "a\n\nb: (c) ch_3Ab9_7 12.50", "x" * 100 + " end.", "Zahlung für ch_9xY1 älter…", "no", "n", "tail  "]
    texts = [(s, x) for k, s in enumerate(("mail", "form", None)) for x in [*odd, *(writer(j, 60 + 40 * j) for j in range(k, 20))]]
    t = run(spark, [(i, *d) for i, d in enumerate(texts + texts[:9])])
    cuts, kinds = defaultdict(Counter), defaultdict(set)
    for s, x in texts:
        for p in range(1, len(x)):
            c = tr.chain(x[:p])
            for scope in {s or tr.ALL, tr.ALL}:
                cuts[scope].update(enumerate(c))
                for level in range(1, len(c)):
                    kinds[scope, level, c[level - 1]].add(c[level])
    first = Counter()
    for r in t.first.collect():
        for scope in {r.source or tr.ALL, tr.ALL}:
            first[scope, r.g1] += r.i
    assert first == Counter({(s, g): n for s, c in cuts.items() for (level, g), n in c.items() if level == 1})
    text_of = {(r.h1, r.h2): (texts + texts[:9])[r.id][1] for r in t.rows.collect()}
    ends = {tr.chain(tr.marked(x)[0]) for _, x in texts}
    rows = placed = 0
    for z in (tr.Bucket.unpack(bytes(r.data)).z for r in t.buckets.collect()):
        for j, (h1, h2) in enumerate(zip(z["h1"].tolist(), z["h2"].tolist())):
            c, scope = tr.chain(tr.marked(text_of[h1, h2])[0]), str(z["scopes"][z["scope"][j]])
            for level in range(2, len(c)):
                assert z[f"i{level}"][z[f"n{level}"][j]] == cuts[scope][level, c[level]]
                if level > 2:
                    assert z[f"ti{level}"][z[f"n{level - 1}"][j]] == len(kinds[scope, level, c[level - 1]])
        rows, placed = rows + len(z["h1"]), placed + z["c_n"].sum()
    assert rows == sum(1 + (s is not None) for s, _ in texts)
    assert round(placed) == sum(cuts[tr.ALL][1, g] for g in {c[1] for c in ends})

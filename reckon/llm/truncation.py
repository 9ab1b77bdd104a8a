"""Texts cut off by a field limit or in transfer: censored lengths combined with ending evidence.

Lengths. A field limit censors lengths: every longer text is stored with the limit's length. Per
source, lengths that occur far more often than their neighbours are candidate limits, in characters
or in UTF-8 bytes. A length distribution (log-normal or normal, whichever fits better) is fitted by
maximum likelihood with the texts at candidates as right-censored values. What it expects to end
naturally at a candidate's length gives the prior probability that a text there is cut.

Endings. How a text ends that was cut is told from how one ends that is whole. The ones are the endings
that all texts have at every place inside them, the others those of all texts as they are. Endings are
chains of growing length (kind of the last character, last one to four words and signs), digits and ids
reduced to their shape, smoothed for endings never seen; a source's own counts weigh beside those of all
texts the less the fewer texts it has.

Notices. A bracketed group at the very end may be a notice that a transfer put after its cut, or part
of the text. Groups of equal wording are told apart by what stands before them: cuts fall anywhere,
also inside words, what people put in brackets follows whole words. That ratio is learnt from all
places too, and adds up over all texts of a wording; a wording that only one text has is part of it.

All combine by Bayes' rule, with the share of cut texts at each candidate, and among all other
lengths (cuts in transfer), fitted by expectation maximisation over counts of all texts of the source.
Words are counted per task by what stands before them, whole; the places inside them are gone through
where the counts meet the texts that end in the same words (a bucket). No text leaves its task. What
the driver holds are counts by last word, by length and by ratio, and a row a source.
"""

from __future__ import annotations

import io
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reckon.operators.scale import broadcast_if, materialize

#: The scope of all texts together; a source of that very name is judged like texts without one.
ALL = "*"
#: Texts as which the statistics of all texts count beside a source's own.
POOL = 30
#: Least chance of a cut that makes a length a cell.
LEAST_PRIOR = 0.05
#: Characters a stored text may be shorter than its limit: a space or a broken character was removed.
SLACK = 3
#: Spikes that a source without limits may show by chance.
FALSE_SPIKES = 1e-3

#: Marks at the end: none, ellipsis, a broken character.
PLAIN, ELLIPSIS, BROKEN = 0, 1, 2
MARKS = 3

#: Signs that close a group at the end of a text, and those that open it.
BRACKETS = {"]": "[", ")": "(", ">": "<"}
#: Longest piece of a word that counts as one; longer ones are taken in pieces.
PIECE = 40
_TOKEN = re.compile(rf"\w{{1,{PIECE}}}|\n|[^\w\s]")
#: The same with the blanks behind, which leaves no character out.
_SPACED = re.compile(rf"(?:\w{{1,{PIECE}}}|\n|[^\w\s]|^)[^\S\n]*")
_DIGIT = re.compile(r"\d")
_PATTERN = str.maketrans({**dict.fromkeys("0123456789", "9"), **{chr(c): "a" for c in range(97, 123)}, **{chr(c): "A" for c in range(65, 91)}})
#: Words of the longest ending that is counted.
DEPTH = 4
CHAIN = [f"g{i}" for i in range(DEPTH + 1)]
#: Texts that must share an ending, if each were cut once, before what comes before it counts.
ENOUGH = 2.5
#: Other texts with an ending that don't vouch for it yet: they may be cut themselves.
VOUCH = 1.0
#: Times that the endings are counted, each with what the time before found.
ROUNDS = 3
#: Characters that hold the last ``DEPTH`` words and signs of any ending.
WINDOW = 6 * PIECE
#: Words that a task counts at once; different words and counts that it holds until it gives them out.
BATCH, MOST_WORDS, MOST_COUNTS = 1_000_000, 300_000, 1_000_000
#: Rows and texts that a bucket of endings holds on average.
BUCKET_ROWS, BUCKET_TEXTS = 200_000, 50_000
#: Bins of the ratio of cut endings per unit, for its median.
FINE = 16


def canonical(word: str) -> str:
    """A word from its first digit on with digits as 9 and letters as a or A, so that ids of one pattern are one."""
    first = _DIGIT.search(word)
    if not first:
        return word
    at = first.start()
    if word.isascii():
        return word[:at] + word[at:].translate(_PATTERN)
    return word[:at] + "".join("9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c for c in word[at:])


def shape(word: str) -> str:
    """A word with digits as 9; an id of letters and digits as its prefix and length."""
    if not _DIGIT.search(word):
        return word
    if word.isdigit():
        return "9" * len(word)
    prefix, _, rest = word.rpartition("_")
    return f"{prefix}_X{len(rest)}"


def kind(ch: str) -> int:
    """What the last character is: of a closed set of classes."""
    if ch in ".!?。！？":
        return 1
    if ch.islower():
        return 2
    if ch.isupper():
        return 3
    if ch.isdigit():
        return 4
    if ch.isspace():
        return 5
    if ch in ")]}":
        return 6
    if ch in ",;:":
        return 7
    if ch in "\"'»“”’":
        return 8
    return 9 if ch.isalpha() else 10


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two, not symmetric."""
    with np.errstate(over="ignore"):
        x = a.astype(np.uint64) ^ (b.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(29))).astype(np.int64)


def _first_hash(k: int, word: str) -> int:
    return digest(f"{k}\x1f{shape(word)}")


def _where(context: np.ndarray, first: np.ndarray) -> np.ndarray:
    """What decides on the bucket: the word before the last, and how the last begins. A cut inside a word lies where the whole word does."""
    return _mix(context, first)


def last_words(text: str) -> tuple[int, int, int, list[str]]:
    """Of the end: kind of the last character, hash of that and the last word, its first character, and the words before it."""
    end = text[-WINDOW:]
    if len(text) > WINDOW:
        end = end[re.match(r"\w*", end).end() :] or end
    words = _TOKEN.findall(end)[-DEPTH:]
    if end[-1:].isspace() and end[-1:] != "\n":
        words.append(" ")
    words = [""] * DEPTH + [canonical(w) for w in words]
    k = kind(end[-1]) if end else 0
    return k, _first_hash(k, words[-1]), ord(words[-1][:1] or " "), words[-2 : -DEPTH - 1 : -1]


def chains(texts: list[str]) -> np.ndarray:
    """The ending of each text as a chain: kind of the last character, then hashes of the last one to ``DEPTH`` words; and what decides on its bucket.

    Each level contains the one before. A trailing blank counts as a word of its own.
    """
    out = np.zeros((len(texts), DEPTH + 2), np.int64)
    if texts:
        ends = [last_words(t) for t in texts]
        out[:, :2] = [e[:2] for e in ends]
        before = np.array([[digest(shape(w)) for w in e[3]] for e in ends], np.int64)
        context = _mix(np.zeros(len(ends), np.int64), before[:, 0])
        out[:, -1] = _where(context, np.array([e[2] for e in ends]))
        for level in range(2, DEPTH + 1):
            out[:, level] = _mix(out[:, 1], context)
            if level < DEPTH:
                context = _mix(context, before[:, level - 1])
    return out


def chain(text: str) -> tuple[int, ...]:
    return tuple(chains([text])[0, :-1].tolist())


def last_word(text: str) -> int:
    """The first two levels of ``chain``, as one: kind of the last character and last word."""
    return last_words(text)[1]


def marked(text: str) -> tuple[str, int]:
    """The text without a sign that was put after the cut, and what that was."""
    if text.endswith("\ufffd"):
        return text.rstrip("\ufffd") or " ", BROKEN
    # Three full stops end sentences of their own accord; only the single sign is put after a cut.
    if text.endswith("…"):
        return text[:-1].rstrip(" ") or " ", ELLIPSIS
    return text, PLAIN


def last_group(text: str) -> tuple[str, str] | None:
    """(what stands before the group in brackets or between dashes that ends the text, the group's wording with digits as 9), if there is one."""
    end = text.rstrip()
    line, sign = end.rfind("\n") + 1, end[-1:]
    if sign in BRACKETS:
        start = end.rfind(BRACKETS[sign], line)
        if start < 0 or sign in end[start:-1]:
            return None
    elif end.endswith("--"):
        start = end.rfind("--", line, len(end.rstrip("-")))
        if start < 0:
            return None
        start = len(end[:start].rstrip("-"))
    else:
        return None
    body = end[:start].rstrip()
    return (body.removesuffix("...").rstrip("…"), _DIGIT.sub("9", end[start:])) if body else None


def digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - 2**63


def places(text: str, seed: int, many: int = 4) -> list[int]:
    """Up to ``many`` places inside the text, drawn from a seed, one in each equal part of the whole text."""
    n = len(text)
    many = min(many, n // 4)
    rng = seed & (2**64 - 1)
    out = []
    for i in range(many):
        rng = (rng * 6364136223846793005 + 1442695040888963407) & (2**64 - 1)
        part = (n - 1) // many
        out.append(1 + i * part + (rng >> 33) % max(1, part))
    return out


_LONGS = ", ".join(f"{g} long" for g in CHAIN)


def endings(documents: DataFrame, *, id: str, source: str, text: str) -> DataFrame:
    """Per document with a text: id, source, digest (h1, h2), lengths, mark, ending chain, and of a group at the end its wording and the word before it. No text is kept."""
    t = F.col(text)
    rows = documents.where(F.length(t) > 0).select(F.col(id).alias("id"), F.col(source).cast("string").alias("source"), F.xxhash64(t).alias("h1"), F.xxhash64(F.lit(1), t).alias("h2"), F.length(t).alias("chars"), F.octet_length(t).alias("bytes"), t.alias("t"))
    kept = ["id", "source", "h1", "h2", "chars", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, out = [], []
            for x in batch.column("t"):
                whole = x.as_py()
                body, mark = marked(whole)
                group = last_group(whole)
                bodies.append(body)
                out.append((mark, digest(group[1]) if group else None, last_word(group[0]) if group else None))
            cols = list(zip(*out)) or [[]] * 3
            levels = [pa.array(x) for x in chains(bodies).T]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(cols[0], pa.int32()), *levels, *[pa.array(c, pa.int64()) for c in cols[1:]]], names=[*kept, "mark", *CHAIN, "at", "wording", "before"])

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, source string, h1 long, h2 long, chars int, bytes int, mark int, {_LONGS}, at long, wording long, before long")


class _Words(dict):
    """Numbers of words as they stand with the blanks behind them, and of the different words that they are."""

    def __init__(self):
        self.words: dict[str, int] = {}
        self.hash, self.first = [], []
        self.word, self.blanks, self.after = [], [], []
        self[""], self.number(" ")

    def number(self, word: str) -> int:
        n = self.words.setdefault(word, len(self.words))
        if n == len(self.hash):
            self.hash.append(digest(shape(word)))
            self.first.append(ord(word[:1] or " "))
        return n

    def __missing__(self, spaced: str) -> int:
        word = spaced.rstrip() if spaced[:1] != "\n" else "\n"
        self.word.append(self.number(canonical(word)))
        self.blanks.append(len(spaced) - len(word))
        self.after.append(spaced[len(word) : len(word) + 1] == " ")
        self[spaced] = n = len(self)
        return n


def cut_words(texts: DataFrame) -> DataFrame:
    """(source, word, c2, c3, c4, at, n, after): how often each word stands behind the same words, in all texts.

    texts: source, t, share (what a text counts). A cut at any place but the end ends in the first
    characters of a word or in a blank: all places are in these rows, counted per task.
    ``after``: how often a blank follows, where the word is whole.
    """

    def counted(v: _Words, ids: list[np.ndarray], sources: list[int], shares: list[float]) -> list[np.ndarray]:
        """Key, source, word, contexts, place, n and after of each different row."""
        gap = np.zeros(DEPTH - 1, np.int32)
        many = [len(x) + len(gap) for x in ids]
        x = np.concatenate([y for i in ids for y in (gap, i)])
        source, share = np.repeat(np.array(sources, np.int32), many), np.repeat(shares, many)
        word, blanks, after = (np.array(c, k)[x] for c, k in ((v.word, np.int32), (v.blanks, np.int32), (v.after, bool)))
        key = source.astype(np.uint64)
        for k in range(DEPTH):
            # A linear hash of the words' numbers; overflow is meant.
            key *= np.uint64(0xD1342543DE82EF95)
            key[k:] += word[: len(word) - k].astype(np.uint64)
        _, one, group = np.unique(key, return_index=True, return_inverse=True)
        n, whole, blank = (np.bincount(group, c, len(one)) for c in (share, share * after, share * blanks))
        # Words by what stands before them, and blanks by the word as well.
        back = [word[np.maximum(one - k, 0)] for k in range(DEPTH)]
        hashes, first = np.array(v.hash, np.int64), np.array(v.first, np.int32)
        parts = []
        for use, words, before, counts in ((back[0] != v.number(""), back[0], back[1:], (n, whole)), (blank > 0, np.full(len(one), v.number(" "), np.int32), back[:-1], (blank, np.zeros(len(one))))):
            context = [np.zeros(use.sum(), np.int64)]
            for w in before:
                context.append(_mix(context[-1], hashes[w[use]]))
            words, from_ = words[use], source[one][use]
            parts.append((_mix(_mix(context[-1], words), from_), from_, words, *context[1:], _where(context[1], first[words]), *[c[use] for c in counts]))
        return summed([np.concatenate(c) for c in zip(*parts)])

    def summed(both: list[np.ndarray]) -> list[np.ndarray]:
        key, one, group = np.unique(both[0], return_index=True, return_inverse=True)
        return [key, *[c[one] for c in both[1:-2]], *[np.bincount(group, c, len(one)) for c in both[-2:]]]

    def together(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
        return summed([np.concatenate(c) for c in zip(a, b)])

    def given(v: _Words, sources: dict[str | None, int], counts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        named = lambda i, of: pa.DictionaryArray.from_arrays(pa.array(i), pa.array(of, pa.string())).cast(pa.string())
        yield pa.RecordBatch.from_arrays([named(counts[1], list(sources)), named(counts[2], list(v.words)), *[pa.array(c) for c in counts[3:]]], names=["source", "word", "c2", "c3", "c4", "at", "n", "after"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, sources, counts, ids, names, shares, held = _Words(), {}, None, [], [], [], 0
        for batch in batches:
            for t, s, n in zip(batch.column("t"), batch.column("source").to_pylist(), batch.column("share").to_pylist()):
                ids.append(np.fromiter(map(v.__getitem__, _SPACED.findall(t.as_py()[:-1])), np.int32))
                names.append(sources.setdefault(s, len(sources)))
                shares.append(n)
                held += len(ids[-1])
                if held >= BATCH:
                    now = counted(v, ids, names, shares)
                    counts = together(counts, now) if counts else now
                    ids, names, shares, held = [], [], [], 0
                    if len(v) > MOST_WORDS or len(counts[0]) > MOST_COUNTS:
                        yield from given(v, sources, counts)
                        v, sources, counts = _Words(), {}, None
        if ids:
            now = counted(v, ids, names, shares)
            counts = together(counts, now) if counts else now
        if counts:
            yield from given(v, sources, counts)

    return texts.select("source", "t", "share").mapInArrow(run, "source string, word string, c2 long, c3 long, c4 long, at long, n double, after double")


def prefixes(word: str) -> list[tuple[int, int]]:
    """(kind of the last character, hash with the word) of all that a cut can leave of a word."""
    return [(k, _first_hash(k, word[:i])) for i in range(1, len(word) + 1) for k in (kind(word[i - 1]),)]


def first_level(words: DataFrame) -> DataFrame:
    """(source, g0, g1, i, after): cut endings by their last word, and whole words before a blank, over all places of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for s, word, n, after in zip(*(b.column(c).to_pylist() for c in ("source", "word", "n", "after"))):
                ends = prefixes(word)
                out += [(s, k, g, n, 0.0) for k, g in ends]
                out[-1] = (*out[-1][:4], after)
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, y) for c, y in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.float64()))], names=["source", "g0", "g1", "i", "after"])

    by_word = words.groupBy("source", "word").agg(F.sum("n").alias("n"), F.sum("after").alias("after"))
    out = by_word.mapInArrow(run, "source string, g0 int, g1 long, i double, after double")
    return out.groupBy("source", "g0", "g1").agg(F.round(F.sum("i"), 6).alias("i"), F.round(F.sum("after"), 6).alias("after"))


# --- lengths -----------------------------------------------------------------------------------


def spikes(lengths: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
    """(length, texts) of lengths that occur far more often than the shorter and the longer ones beside them.

    A limit leaves fewer texts above it, and a distribution that begins steeply has as many above. The
    bar rises with the number of lengths looked at, so that ``FALSE_SPIKES`` would pass it by chance.
    """
    found = []
    total = np.concatenate([[0], np.cumsum(counts)])
    bar = math.log(max(1, len(lengths)) / FALSE_SPIKES)
    for i, (at, n) in enumerate(zip(lengths, counts)):
        width = max(10, int(at * 0.05))
        lo, hi = np.searchsorted(lengths, at - width), np.searchsorted(lengths, at + width, "right")
        usual = max((total[i] - total[lo] + 0.5) / min(width, max(1, at - 1)), (total[hi] - total[i + 1]) / width)
        if n >= 4 * usual and n * math.log(n / usual) - (n - usual) >= bar:
            found.append((int(at), int(n)))
    return found


def candidate_limits(hist: dict[str, tuple[np.ndarray, np.ndarray]], shared: dict[tuple[int, int], int] | None = None) -> list[tuple[str, int]]:
    """(unit, length) of the candidate limits of one source.

    A spike just below a larger one is that limit with characters removed; a smaller one in the other
    unit that the same texts can cause (a character takes up to four bytes) is that limit again, if
    at least half of its texts are at that limit too. shared: texts by length in characters and in
    bytes, for spikes in both; without it, spikes of the two units count as the same texts.
    """
    by_spike: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for (chars, size), n in (shared or {}).items():
        by_spike.setdefault(("chars", chars), []).append((size, n))
        by_spike.setdefault(("bytes", size), []).append((chars, n))

    def at_both(unit: str, at: int, n: int, limit: int) -> bool:
        return shared is None or 2 * sum(k for x, k in by_spike.get((unit, at), []) if limit - SLACK <= x <= limit) >= n

    every = sorted(((n, unit, at) for unit, (ls, cs) in hist.items() for at, n in spikes(ls, cs)), key=lambda x: (-x[0], x[1] != "chars", x[2]))
    kept: list[tuple[str, int]] = []
    for n, unit, at in every:
        same = any(u == unit and limit - SLACK <= at <= limit for u, limit in kept)
        other = any(u != unit and (limit <= at <= 4 * limit if u == "chars" else at <= limit <= 4 * at) and at_both(unit, at, n, limit) for u, limit in kept)
        if not same and not other:
            kept.append((unit, at))
    return kept


def normal_tail(z: np.ndarray) -> np.ndarray:
    return 0.5 * np.vectorize(math.erfc)(z / math.sqrt(2))


def fit_censored(x: np.ndarray, n: np.ndarray, c: np.ndarray, m: np.ndarray) -> tuple[float, float, float]:
    """(mean, deviation, log likelihood) of a normal by maximum likelihood.

    x, n: exact values and their counts; c, m: right-censored values and theirs. Expectation
    maximisation on counts: each censored value stands for its conditional moments above it.
    """
    all_n = n.sum() + m.sum()
    mu = float((x @ n + c @ m) / all_n)
    sd = max(1e-3, math.sqrt(max(0.0, float((((x - mu) ** 2) @ n + ((c - mu) ** 2) @ m) / all_n))))
    for _ in range(100):
        z = np.clip((c - mu) / sd, -30, 30)
        hazard = np.exp(-z * z / 2) / math.sqrt(2 * math.pi) / np.maximum(normal_tail(z), 1e-300)
        hazard = np.where(z > 25, z, hazard)
        first = mu + sd * hazard
        second = mu**2 + sd**2 + sd * (c + mu) * hazard
        new = float((x @ n + first @ m) / all_n)
        var = float(((x**2) @ n + second @ m) / all_n) - new**2
        done = abs(new - mu) < 1e-7 * max(1, abs(mu))
        mu, sd = new, math.sqrt(max(var, 1e-6))
        if done:
            break
    z = np.clip((c - mu) / sd, -30, 30)
    like = float((-(((x - mu) / sd) ** 2) / 2 - math.log(sd * math.sqrt(2 * math.pi))) @ n + np.log(np.maximum(normal_tail(z), 1e-300)) @ m)
    return mu, sd, like


def cells_of(hist: dict[str, tuple[np.ndarray, np.ndarray]], shared: dict[tuple[int, int], int] | None = None) -> list[tuple]:
    """(unit, limit, length, texts, natural, prior) of each candidate cell of one source.

    natural: how many of all texts the fitted distribution expects to end at the cell's length.
    """
    out = []
    limits = candidate_limits(hist, shared)
    for unit, (ls, cs) in hist.items():
        own = sorted((limit for u, limit in limits if u == unit), reverse=True)
        if not own:
            continue
        at = {length: limit for limit in own for length in range(limit - SLACK, limit + 1)}
        cens = np.array([int(x) in at for x in ls])
        x, n, c, m = ls[~cens].astype(float), cs[~cens].astype(float), ls[cens].astype(float), cs[cens].astype(float)
        if not len(x):
            density = lambda v: 0.0
        else:
            lin, log = fit_censored(x, n, c, m), fit_censored(np.log(x), n, np.log(c), m)
            if log[2] - float(np.log(x) @ n) >= lin[2]:
                density = lambda v, f=log: math.exp(-(((math.log(v) - f[0]) / f[1]) ** 2) / 2) / (v * f[1] * math.sqrt(2 * math.pi))
            else:
                density = lambda v, f=lin: math.exp(-(((v - f[0]) / f[1]) ** 2) / 2) / (f[1] * math.sqrt(2 * math.pi))
        everything = float(cs.sum())
        for length, count in zip(ls[cens], cs[cens]):
            natural = everything * density(float(length))
            prior = min(0.995, max(LEAST_PRIOR, 1 - natural / float(count)))
            out.append((unit, int(at[int(length)]), int(length), int(count), float(natural), prior))
    return out


def length_cells(texts: DataFrame) -> DataFrame:
    """(scope, unit, limit, length, texts, natural, prior): candidate cells of every source and of all.

    The scope of all has its own candidates and those of every source; what the sources' texts there
    have beyond those expected naturally is the prior for a text of unknown source.
    """
    lengths = F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("length")))
    by_source = texts.select("source", F.explode(lengths).alias("x")).groupBy("source", "x.unit", "x.length").agg(F.count(F.lit(1)).alias("n"))
    hist = materialize(_scopes(by_source).groupBy("scope", "unit", "length").agg(F.sum("n").alias("n")))
    by_unit = lambda pdf: {u: (g["length"].to_numpy(), g["n"].to_numpy()) for u, g in pdf.sort_values("length").groupby("unit")}

    def peaks(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame([(u, at) for u, h in by_unit(pdf).items() for at, _ in spikes(*h)], columns=["unit", "length"])
        out.insert(0, "scope", pdf["scope"].iloc[0])
        return out

    # A group holds a source's different lengths, not its texts.
    peak = hist.groupBy("scope").applyInPandas(peaks, "scope string, unit string, length int")
    # A text is near a limit with characters removed, too.
    near = materialize(peak.select("scope", "unit", F.explode(F.sequence(F.col("length") - SLACK, F.col("length"))).alias("length")).distinct())
    sizes = texts.groupBy("source", "chars", "bytes").agg(F.count(F.lit(1)).alias("n"))
    scoped = _scopes(sizes)
    for unit in ("chars", "bytes"):
        scoped = scoped.join(near.where(F.col("unit") == unit).select("scope", F.col("length").alias(unit)), ["scope", unit], "left_semi")
    shared = scoped.groupBy("scope", "chars", "bytes").agg(F.sum("n").alias("n"))

    def fit(pdf: pd.DataFrame, both: pd.DataFrame) -> pd.DataFrame:
        pairs = {(int(c), int(b)): int(n) for c, b, n in zip(both["chars"], both["bytes"], both["n"])}
        out = pd.DataFrame(cells_of(by_unit(pdf), pairs), columns=["unit", "limit", "length", "texts", "natural", "prior"])
        out.insert(0, "scope", pdf["scope"].iloc[0] if len(pdf) else ALL)
        return out

    schema = "scope string, unit string, limit int, length int, texts long, natural double, prior double"
    cells = materialize(hist.groupBy("scope").cogroup(shared.groupBy("scope")).applyInPandas(fit, schema))
    own, at = cells.where(F.col("scope") != ALL), ["unit", "length"]
    beyond = own.groupBy(*at).agg(F.min("limit").alias("limit"), F.sum(F.greatest(F.col("texts") - F.col("natural"), F.lit(0.0))).alias("beyond"))
    there = hist.where(F.col("scope") == ALL).groupBy(*at).agg(F.sum("n").alias("there"))
    union = beyond.join(there, at).withColumn("chance", F.least(F.greatest(F.col("beyond") / F.col("there"), F.lit(LEAST_PRIOR)), F.lit(0.995)))
    pool = cells.where(F.col("scope") == ALL).select(*at, F.col("limit").alias("l"), "texts", "natural", "prior").join(union, at, "full_outer")
    pool = pool.select(
        F.lit(ALL).alias("scope"), "unit", F.coalesce("l", "limit").alias("limit"), "length", F.coalesce("texts", "there").alias("texts"),
        F.coalesce("natural", F.col("there") - F.col("beyond")).alias("natural"), F.greatest("prior", "chance").alias("prior"),
    )
    return own.unionByName(pool)


def _scopes(df: DataFrame) -> DataFrame:
    """Each row under its source and under the scope of all."""
    return df.withColumn("scope", F.explode(F.array_distinct(F.array(F.coalesce("source", F.lit(ALL)), F.lit(ALL)))))


def in_cells(texts: DataFrame, cells: DataFrame) -> DataFrame:
    """Adds ``cell`` (unit and length, '' for none) and ``prior`` by scope; bytes yield to characters.

    A limit that only other sources show counts in part: the less, the more texts the source has by
    which it would show there (``trust``).
    """
    both, chance = texts, {}
    for unit, own, every in (("chars", "pc", "ac"), ("bytes", "pb", "ab")):
        of = cells.where(F.col("unit") == unit)
        both = both.join(of.select("scope", F.col("length").alias(unit), F.col("prior").alias(own)), ["scope", unit], "left")
        both = both.join(of.where(F.col("scope") == ALL).select(F.col("length").alias(unit), F.col("prior").alias(every)), unit, "left")
        p = F.greatest(F.col(own), (1 - F.col("trust")) * F.col(every))
        chance[unit] = F.when(p >= LEAST_PRIOR, p)
    both = both.withColumn("hc", chance["chars"]).withColumn("hb", chance["bytes"])
    use_c = F.col("hc").isNotNull() & (F.coalesce("hb", F.lit(0.0)) <= F.col("hc"))
    cell = F.when(use_c, F.concat(F.lit("c"), "chars")).when(F.col("hb").isNotNull(), F.concat(F.lit("b"), "bytes")).otherwise("")
    return both.withColumn("cell", cell).withColumn("prior", F.when(use_c, F.col("hc")).otherwise(F.coalesce("hb", F.lit(0.0)))).drop("pc", "pb", "ac", "ab", "hc", "hb")


# --- endings -----------------------------------------------------------------------------------


def _part(x: np.ndarray) -> np.ndarray:
    """A kind of ending counts in part as far as a second text of it is likely whole: most single ones are those of cut texts."""
    return np.clip(x - 1, 0, 1)


def _unseen(kinds_here: np.ndarray, n: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Share of endings that were new (Witten-Bell), spread over all kinds seen."""
    return (kinds_here + 0.5) / (n + kinds_here + 1) / kinds


def step(e, i, ne, ni, te, ti, w, level: int, least=0.0) -> np.ndarray:
    """log P(ending | cut) / P(ending | whole) of one level of the chain, given the level before.

    e, i: texts and cuts with the ending; ne, ni, te, ti: those with what follows it, and their kinds.
    w: what the text itself adds to e, which is left out. Words further back say nothing where one
    side hardly ever had what follows them; least: the cuts that it must have had.
    """
    own_e, own_ne = np.maximum(e - w, 0), np.maximum(ne - w, 0)
    own_te = np.maximum(te - _part(e) + _part(own_e), 0)
    kinds = te + ti + 1
    whole = np.maximum(np.maximum(own_e - VOUCH, 0) / np.maximum(own_ne + own_te, 1e-9), _unseen(own_te, own_ne, kinds))
    cut = np.maximum(i / np.maximum(ni + ti, 1), _unseen(ti, ni, kinds))
    known = (own_ne >= 0.5) & ((ni >= least) | (level < 2))
    return np.where(known, np.log(cut) - np.log(whole), 0.0)


def drawn(own: np.ndarray, every: np.ndarray, trust: np.ndarray) -> np.ndarray:
    """The ratio by a source's own counts and those of all texts: an ending must be usual in both, as far as the source is trusted, to speak for a whole text."""
    return every + np.maximum(0, trust * (own - every))


def verdict_keys(d: pd.DataFrame) -> np.ndarray:
    """One key of scope, cell and mark."""
    key = d["mark"].to_numpy(np.int64)
    for c in ("scope", "cell"):
        codes, names = pd.factorize(d[c])
        key = _mix(key, np.array([digest(str(x)) for x in names], np.int64)[codes])
    return key


class Table:
    """Endings by key: e (whole texts), i (cuts), te and ti (kinds of either that lie below)."""

    def __init__(self, key: np.ndarray, *columns: np.ndarray):
        order = np.argsort(key)
        self.key, self.columns = key[order], [np.asarray(c, float)[order] for c in columns]

    def at(self, key: np.ndarray) -> list[np.ndarray]:
        at, has = found_in(self.key, key)
        return [np.where(has, c[at], 0.0) if len(c) else np.zeros(len(key)) for c in self.columns]


def found_in(keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted keys, whether it is there)."""
    if not len(keys):
        return np.zeros(len(key), int), np.zeros(len(key), bool)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return at, keys[at] == key


class Levels:
    """The first two levels of the endings of all texts: by scope, kind of the last character, and last word. The others lie in buckets."""

    def __init__(self, words: pd.DataFrame, kinds: pd.DataFrame):
        """words: sk, g0, g1, e, i, te, ti of endings that texts have. kinds: sk, g0, i, ti over all cuts."""
        by_kind = words.assign(te=_part(words["e"].to_numpy())).groupby(["sk", "g0"], as_index=False).agg(e=("e", "sum"), te=("te", "sum"))
        by_kind = by_kind.merge(kinds, on=["sk", "g0"], how="outer").fillna(0.0)
        root = by_kind.assign(te=_part(by_kind["e"].to_numpy()), ti=(by_kind["i"] > 0).astype(float)).groupby("sk", as_index=False)[["e", "i", "te", "ti"]].sum()
        counts = lambda d: [d[c].to_numpy(float) for c in ("e", "i", "te", "ti")]
        longs = lambda d, c: d[c].to_numpy(np.int64)
        self.tables = [Table(longs(root, "sk"), *counts(root)), Table(_mix(longs(by_kind, "g0"), longs(by_kind, "sk")), *counts(by_kind)), Table(_mix(longs(words, "g1"), longs(words, "sk")), *counts(words))]

    def ratio(self, sk: np.ndarray, kinds: np.ndarray, words: np.ndarray, w: np.ndarray | float = 0.0) -> tuple[np.ndarray, list[np.ndarray]]:
        """The log ratio of the first two levels; the counts by last word, and the cuts that are enough."""
        root, by_kind, by_word = (t.at(k) for t, k in zip(self.tables, (sk, kinds, words)))
        enough = ENOUGH * root[1] / np.maximum(root[0], 1.0)
        return step(*by_kind[:2], *root, w, 0) + step(*by_word[:2], *by_kind, w, 1), [*by_word, enough]


class Bucket:
    """The endings of some texts and cuts from the last two words on: a whole part of the chains, as arrays.

    Texts lie in it once in their source's scope and once in that of all. Cuts whose last word no text
    ends with aren't here, as the levels above say all of them; cuts that count alike are one row.
    """

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.z = arrays

    @staticmethod
    def of(texts: pd.DataFrame, cuts: pd.DataFrame, ends: np.ndarray, of_all: int) -> "Bucket":
        texts = texts.sort_values(["t", "scope"], ignore_index=True)
        sk, t = texts["sk"].to_numpy(np.int64), texts["t"].to_numpy(np.int64)
        g = [texts[c].to_numpy(np.int64) for c in CHAIN]
        z = {c: texts[c].to_numpy() for c in ("h1", "h2", "sk", "mark", "prior", "trust", "noticed", "used", "own")}
        for c in ("scope", "cell"):
            z[f"{c}s"], z[c] = np.unique(texts[c].to_numpy(str), return_inverse=True)
        z["vk"] = verdict_keys(texts)
        of = np.flatnonzero(sk == of_all)
        z["every"] = of[np.searchsorted(t[of], t)] if len(of) else of
        z |= {"kind": _mix(g[0], sk), "word": _mix(g[1], sk)}
        _, first, z["n1"] = np.unique(z["word"], return_index=True, return_inverse=True)
        z |= {"u_sk": sk[first], "u_g0": g[0][first], "u_g1": g[1][first]}
        nodes = []
        for level in range(2, DEPTH + 1):
            keys, first, z[f"n{level}"] = np.unique(_mix(g[level], sk), return_index=True, return_inverse=True)
            z[f"up{level}"] = z[f"n{level - 1}"][first]
            nodes.append(keys)
        # Every place inside the words at which a text could have ended.
        codes, words = pd.factorize(cuts["word"])
        each = [prefixes(w) for w in words]
        many = np.array([len(x) for x in each], int)
        starts = np.concatenate([[0], np.cumsum(many)])
        flat = np.array([x for y in each for x in y], np.int64).reshape(-1, 2)
        usual = found_in(ends, flat[:, 1])[1]
        row = np.repeat(np.arange(len(cuts)), many[codes] if len(cuts) else 0)
        at = np.arange(len(row)) - np.repeat(np.cumsum(many[codes]) - many[codes], many[codes]) + starts[codes][row] if len(row) else row
        row, at = row[usual[at]], at[usual[at]]
        n, g0, g1, source = cuts["n"].to_numpy(float)[row], flat[at, 0], flat[at, 1], cuts["sk"].to_numpy(np.int64)[row]
        own = np.flatnonzero(source != of_all)
        both = np.concatenate([own, np.arange(len(row))])
        scope = np.concatenate([source[own], np.full(len(row), of_all)])
        nb, word = n[both], _mix(g1[both], scope)
        b_key, first, b = np.unique(word, return_index=True, return_inverse=True)
        z |= {"b_sk": scope[first], "b_g0": g0[both][first], "b_g1": g1[both][first]}
        columns, here, up = [b], np.ones(len(both), bool), b
        for level, keys in zip(range(2, DEPTH + 1), nodes):
            gl = _mix(g1[both], cuts[f"c{level}"].to_numpy(np.int64)[row][both])
            node, i, live = np.full(len(both), -1), np.zeros(len(both)), np.flatnonzero(here)
            cut_key, one, group = np.unique(_mix(gl[live], scope[live]), return_index=True, return_inverse=True)
            # Rounded as shares of copies add up to whole numbers.
            i_of = np.round(np.bincount(group, nb[live], len(cut_key)), 6)
            place, has = found_in(keys, cut_key)
            node[live], i[live] = np.where(has, place, -1)[group], i_of[group]
            z[f"i{level}"] = np.bincount(place[has], i_of[has], len(keys))
            z[f"ti{level}"] = np.bincount(up[live][one], i_of > 0, len(b_key) if level == 2 else len(nodes[level - 3]))
            here, up = node >= 0, node
            columns += [node, i.astype(np.int64)]
        # What a cut counts by its source and by all texts.
        place = np.arange(len(row))
        by_all = [c[len(own) :] for c in columns]
        place[own] = np.arange(len(own))
        is_own = source != of_all
        by_own = [np.where(is_own, c[place], a) if len(c) else a for c, a in zip(columns, by_all)]
        key = source
        for c in (*by_own, *by_all):
            key = _mix(key, c)
        _, one, group = np.unique(key, return_index=True, return_inverse=True)
        z |= {"c_n": np.bincount(group, n, len(one)), "c_sk": source[one]}
        z |= {f"c_own{j}": c[one] for j, c in enumerate(by_own)} | {f"c_all{j}": c[one] for j, c in enumerate(by_all)}
        return Bucket(z)

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: v.astype(np.int32) if v.dtype == np.int64 and k.startswith(("n", "up", "c_own", "c_all")) and (not len(v) or v.max() < 2**31) else v for k, v in self.z.items() if v.dtype != object})
        return out.getvalue()

    @staticmethod
    def unpack(data: bytes) -> "Bucket":
        with np.load(io.BytesIO(data)) as z:
            return Bucket({k: z[k] for k in z.files})

    def counts(self, w: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(e, te of what lies above) of each level from the second on."""
        z, out = self.z, []
        for level in range(2, DEPTH + 1):
            e = np.bincount(z[f"n{level}"], w, len(z[f"i{level}"]))
            out.append((e, np.bincount(z[f"up{level}"], _part(e), len(z["u_sk"]) if level == 2 else len(z[f"i{level - 1}"]))))
        return out

    def _below(self, out: np.ndarray, by_word: list[np.ndarray], counts: list, nodes: list[np.ndarray], cuts: list[np.ndarray], w) -> np.ndarray:
        ne, ni, te, ti, least = by_word
        known = np.ones(len(out), bool)
        for k, (node, i) in enumerate(zip(nodes, cuts)):
            level, has = k + 2, node >= 0
            e = np.where(has, counts[k][0][node], 0.0) if len(counts[k][0]) else np.zeros(len(out))
            out = out + np.where(known, step(e, i, ne, ni, te, ti, w, level, least), 0.0)
            if level < DEPTH and len(counts[k][0]):
                known, ne, ni, te, ti = has, e, self.z[f"i{level}"][node], counts[k + 1][1][node], self.z[f"ti{level + 1}"][node]
            else:
                known = np.zeros(len(out), bool)
        return out

    def text_ratios(self, levels: Levels, w: np.ndarray) -> np.ndarray:
        """The ratio of each text, by its source and all texts; by all texts alone in their scope."""
        z = self.z
        out, by_word = levels.ratio(z["sk"], z["kind"], z["word"], w)
        nodes = [z[f"n{level}"] for level in range(2, DEPTH + 1)]
        alone = self._below(out, by_word, self.counts(w), nodes, [z[f"i{level}"][n] for level, n in zip(range(2, DEPTH + 1), nodes)], w)
        return drawn(alone, alone[z["every"]], z["trust"])

    def cut_ratios(self, levels: Levels, w: np.ndarray, trust: Table) -> tuple[np.ndarray, np.ndarray]:
        """The ratio of each row of cuts by its source and all texts, and by all texts alone."""
        z, counts = self.z, self.counts(w)
        by_b = levels.ratio(z["b_sk"], _mix(z["b_g0"], z["b_sk"]), _mix(z["b_g1"], z["b_sk"]))
        ratios = []
        for x in ("own", "all"):
            b, *rest = (z[f"c_{x}{j}"] for j in range(2 * DEPTH - 1))
            ratios.append(self._below(by_b[0][b], [c[b] for c in by_b[1]], counts, rest[::2], rest[1::2], 0.0))
        own, every = ratios
        return drawn(own, every, trust.at(z["c_sk"])[0]), every

    def chance(self, history: list[tuple[Levels, Table]]) -> np.ndarray:
        """How likely each text is cut, after the rounds so far: they are gone through again, as that takes less than to keep their results."""
        z = self.z
        p = np.maximum(z["prior"], z["noticed"])
        for levels, needs in history:
            ratio = self.text_ratios(levels, z["used"] * (1 - p))
            p = z["noticed"] + (1 - z["noticed"]) / (1 + np.exp(np.clip(needs.at(z["vk"])[0] - ratio, -40, 40)))
        return p


def inside(anywhere: np.ndarray, after: np.ndarray, totals: dict[str, float]) -> np.ndarray:
    """log P(last word | cut anywhere) / P(last word | cut after a word), by the counts of the word before a group at the end; at most 3 either way."""
    logs = []
    for seen, x in ((anywhere, "i"), (after, "after")):
        n, kinds = totals[x], totals[f"kinds_{x}"]
        logs.append(np.log(np.maximum(seen / max(n + kinds, 1), _unseen(kinds, n, totals["kinds"] + 1))))
    return np.clip(logs[0] - logs[1], -3, 3)


def medians(hist: pd.DataFrame) -> dict[str, float]:
    """The bin that half of the counts of each scope lie at or below, as a ratio."""
    out = {}
    for scope, d in hist.sort_values("bin").groupby("scope"):
        total = d["n"].cumsum().to_numpy()
        out[scope] = float(d["bin"].to_numpy()[np.searchsorted(total, total[-1] / 2)]) / FINE
    return out


def share_of_notices(sums: np.ndarray, n: np.ndarray) -> float:
    """Share of wordings that are notices, by expectation maximisation over their summed ratios (n wordings each)."""
    pi = 0.5
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(sums + math.log(pi / (1 - pi)), -40, 40)))
        pi = float((1 + (q * n).sum()) / (2 + n.sum()))
    return pi


#: Bounds of the share of texts cut in transfer that is taken from the ratios.
LEAST_SHARE, MOST_SHARE = 0.002, 0.5
#: Bins of the ratio per unit, for the counts that the shares are fitted on.
BINS = 4


def fit_shares(cells: pd.DataFrame, usual: float, every: tuple[float, np.ndarray, np.ndarray] | None = None) -> pd.DataFrame:
    """(scope, cell, mark, threshold, share, of_cut, of_complete): the least ratio at which a text is more likely cut than not.

    cells: counts n by cell, mark and binned ratio of one scope, with the censoring prior. usual: the
    ratio that half of all cut endings exceed, and hardly any whole text: twice the share of texts
    outside the cells that exceed it is the share cut in transfer that the fit starts from. Expectation
    maximisation of the share of cut texts in each cell and of the marks of cut and of complete texts.
    every: share of cuts in transfer and marks of cut and of complete texts in the scope of all, which
    count as ``POOL`` further texts.
    """
    d = cells.groupby(["cell", "mark", "bin"], as_index=False).agg(n=("n", "sum"), prior=("prior", "max"))
    ratio, n, mark = d["bin"].to_numpy() / BINS, d["n"].to_numpy(float), d["mark"].to_numpy()
    names = sorted(d["cell"].unique())
    cell = d["cell"].map({c: i for i, c in enumerate(names)}).to_numpy()
    at_limit = np.array([c != "" for c in names])
    start = np.array([d.loc[d["cell"] == c, "prior"].max() for c in names])
    free = ~at_limit[cell]
    in_transfer = min(MOST_SHARE, max(LEAST_SHARE, 2 * (n * (ratio > usual))[free].sum() / max(1.0, n[free].sum())))
    anchor = np.where(at_limit, start, in_transfer)
    share = anchor.copy()
    # Each share starts as so many texts of the prior: few where a limit shows; for cuts in transfer as
    # many as there are texts, as cuts with ordinary endings would let the share shrink round by round.
    weight = np.where(at_limit, 3.0, max(20.0, n.sum()))
    more_cut, more_complete = np.full((len(names), MARKS), 0.25), np.full(MARKS, 0.05)
    of_cut = np.full((len(names), MARKS), 1 / MARKS)
    of_complete = np.array([0.9, 0.1, 1e-4])
    if every:
        anchor = np.where(at_limit, anchor, (weight * anchor + POOL * every[0]) / (weight + POOL))
        weight = np.where(at_limit, weight, weight + POOL)
        more_cut[~at_limit] += POOL * every[0] * every[1]
        more_complete = more_complete + POOL * (1 - every[0]) * every[2]
    for _ in range(60):
        odds = share[cell] / (1 - share[cell]) * of_cut[cell, mark] / of_complete[mark] * np.exp(np.clip(ratio, -40, 40))
        post = odds / (1 + odds)
        cut, there = np.bincount(cell, n * post, len(names)), np.bincount(cell, n, len(names))
        share = np.clip((cut + weight * anchor) / (there + weight), 1e-4, 0.999)
        for k in range(MARKS):
            of_cut[:, k] = np.bincount(cell, n * post * (mark == k), len(names)) + more_cut[:, k]
            of_complete[k] = (n * (1 - post) * (mark == k)).sum() + more_complete[k]
        of_cut /= of_cut.sum(axis=1, keepdims=True)
        of_complete = np.maximum(of_complete / of_complete.sum(), 1e-5)
    out = []
    for i, c in enumerate(names):
        for k in range(MARKS):
            need = -(math.log(share[i] / (1 - share[i])) + math.log(of_cut[i, k] / of_complete[k]))
            out.append((cells["scope"].iloc[0], c, k, need, float(share[i]), float(of_cut[i, k]), float(of_complete[k])))
    return pd.DataFrame(out, columns=["scope", "cell", "mark", "threshold", "share", "of_cut", "of_complete"])


def pooled_marks(pooled: pd.DataFrame) -> tuple[float, np.ndarray, np.ndarray] | None:
    """What the scope of all says of texts outside the cells, for the sources to be drawn towards."""
    rows = pooled[pooled["cell"] == ""].sort_values("mark")
    return (rows["share"].iloc[0], rows["of_cut"].to_numpy(), rows["of_complete"].to_numpy()) if len(rows) else None


def fit_all_shares(binned: pd.DataFrame, usual: dict[str, float]) -> pd.DataFrame:
    """What ``fit_shares`` gives for every scope: first the scope of all, then the sources drawn towards it."""
    of_all = usual.get(ALL, math.inf)
    by_scope = {s: d for s, d in binned.groupby("scope")}
    pooled = [fit_shares(by_scope.pop(ALL), of_all)] if ALL in by_scope else []
    every = pooled_marks(pooled[0]) if pooled else None
    verdicts = [*pooled, *[fit_shares(d, usual.get(s, of_all), every) for s, d in by_scope.items()]]
    return pd.concat(verdicts) if verdicts else pd.DataFrame({"threshold": [], "scope": [], "cell": [], "mark": []})


def _odds(x: Column) -> Column:
    return 1 / (1 + F.exp(F.least(F.greatest(-x, F.lit(-500.0)), F.lit(500.0))))


def _sk(scope: Column) -> Column:
    return F.xxhash64(scope)


class Truncation:
    """The fitted model over a table of documents, and what follows from it.

    Documents of NULL or empty text never count. Ties and repeated rows are judged alike: a text is
    cut or not wherever it stands, so a copy of a cut text under another source counts too. Everything
    is counted over all texts and all places in them; sample, where given, is the number of texts that
    the endings are counted on at most.
    """

    def __init__(self, documents: DataFrame, *, id: str, source: str, text: str, sample: int | None = None):
        # Written tables of cells, sources and verdicts are a handful of rows a source: the planner
        # broadcasts them by the size of their files, or joins them by shuffle where they outgrow that.
        self.rows = materialize(endings(documents, id=id, source=source, text=text))
        kept = ["source", "h1", "h2", "chars", "bytes", "mark", *CHAIN, "at", "wording", "before"]
        repeats = [c for c in kept if c not in ("source", "h1", "h2")]
        texts = materialize(self.rows.groupBy("source", "h1", "h2").agg(*[F.first(c).alias(c) for c in repeats], F.count(F.lit(1)).alias("copies")))
        self.cells = materialize(length_cells(texts))
        counts = texts.groupBy("source").agg(F.count(F.lit(1)).alias("size"))
        sources = counts.agg(F.count(F.lit(1)).alias("n"))
        rate = F.least(F.lit(1.0), F.lit(float(sample)) / sources.scalar() / F.col("size")) if sample else F.lit(1.0)
        self.sizes = materialize(counts.select(F.coalesce("source", F.lit(ALL)).alias("name"), rate.alias("rate"), (F.col("size") / (F.col("size") + POOL)).alias("trust")).groupBy("name").agg(F.max("rate").alias("rate"), F.max("trust").alias("trust")))
        self._count(documents, texts, source, text)
        placed = self._placed(_scopes(texts)).drop("chars", "bytes")
        self._noticed(texts)
        self._fit(placed)

    def _placed(self, scoped: DataFrame) -> DataFrame:
        """Texts with their scope's ``trust`` and their cell."""
        trust = self.sizes.where(F.col("name") != ALL).select(F.col("name").alias("scope"), "trust")
        return in_cells(scoped.join(trust, "scope", "left").withColumn("trust", F.coalesce("trust", F.lit(1.0))), self.cells)

    def _used(self, rows: DataFrame) -> Column:
        return F.pmod(F.xxhash64(F.lit(2), "h1"), F.lit(1_000_000)) / 1_000_000 < rows["rate"]

    def _count(self, documents: DataFrame, texts: DataFrame, source: str, text: str) -> None:
        """Counts every place at which a text could be cut: by the words around it, and by the last word alone."""
        t = F.col(text)
        docs = documents.where(F.length(t) > 0).select(F.col(source).cast("string").alias("source"), F.xxhash64(t).alias("h1"), F.xxhash64(F.lit(1), t).alias("h2"), t.alias("t"))
        # Copies of a text are cut alike, and count once together.
        copies = broadcast_if(texts.where("copies > 1").select(F.coalesce("source", F.lit(ALL)).alias("name"), "h1", "h2", "copies").groupBy("name", "h1", "h2").agg(F.max("copies").alias("copies")))
        docs = docs.withColumn("name", F.coalesce("source", F.lit(ALL))).join(copies, ["name", "h1", "h2"], "left").join(self.sizes.select("name", "rate"), "name")
        docs = docs.where(self._used(docs)).select("source", "t", (1 / F.coalesce("copies", F.lit(1))).alias("share"))
        self.words = materialize(cut_words(docs))
        self.first = materialize(first_level(self.words))

    def _noticed(self, texts: DataFrame) -> None:
        """How likely each wording of a group at the end is a notice."""
        by_word = self.first.groupBy("g1").agg(F.sum("i").alias("i"), F.sum("after").alias("after"))
        totals = by_word.agg(F.sum("i").alias("i"), F.sum("after").alias("after"), F.count_if(F.col("i") > 0).alias("kinds_i"), F.count_if(F.col("after") > 0).alias("kinds_after"), F.count(F.lit(1)).alias("kinds")).first().asDict()
        totals = {k: v or 0 for k, v in totals.items()}
        grouped = texts.where("wording IS NOT NULL").select("wording", F.col("before").alias("g1")).join(by_word, "g1", "left").select("wording", F.coalesce("i", F.lit(0.0)).alias("i"), F.coalesce("after", F.lit(0.0)).alias("after"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column("wording"), pa.array(inside(b.column("i").to_numpy(), b.column("after").to_numpy(), totals))], names=["wording", "inside"])

        # What only one text has is part of it: a notice recurs.
        groups = materialize(grouped.mapInArrow(run, "wording long, inside double").groupBy("wording").agg(F.sum("inside").alias("sum"), F.count(F.lit(1)).alias("n")).where("n > 1"))
        bins = groups.groupBy(F.round(F.least(F.greatest("sum", F.lit(-30.0)), F.lit(30.0)) * BINS).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")).toPandas()
        pi = share_of_notices(bins["bin"].to_numpy() / BINS, bins["n"].to_numpy(float))
        self.notices = groups.select("wording", _odds(F.col("sum") + math.log(pi / (1 - pi))).alias("noticed")).where("noticed > 0.01")

    def _buckets(self, placed: DataFrame, of_all: int) -> DataFrame:
        """(bucket, data): every text and every cut beside those that end in the same words."""
        session = placed.sparkSession
        ends = self.rows.select("g1").distinct().toArrow().column("g1").to_numpy()
        shared = session.sparkContext.broadcast(np.sort(ends))
        many = self.rows.count() // BUCKET_TEXTS, self.words.count() // BUCKET_ROWS, session.sparkContext.defaultParallelism - 1
        bucket = F.pmod(F.xxhash64("at"), F.lit(max(many) + 1)).cast("int").alias("bucket")
        texts = placed.join(self.notices, "wording", "left").join(self.sizes.select("name", "rate"), F.coalesce("source", F.lit(ALL)) == F.col("name"))
        texts = texts.select(
            bucket, F.xxhash64("h1", "h2", "source").alias("t"), "h1", "h2", "scope", _sk(F.col("scope")).alias("sk"), "cell", "mark", "prior", "trust", *CHAIN, F.coalesce("noticed", F.lit(0.0)).alias("noticed"),
            self._used(texts).alias("used"), (F.col("scope") == F.coalesce("source", F.lit(ALL))).alias("own"),
        )
        cuts = self.words.select(bucket, _sk(F.coalesce("source", F.lit(ALL))).alias("sk"), "word", "c2", "c3", "c4", "n")

        def build(texts: pd.DataFrame, cuts: pd.DataFrame) -> pd.DataFrame:
            b = (texts if len(texts) else cuts)["bucket"].iloc[0]
            return pd.DataFrame({"bucket": [b], "data": [Bucket.of(texts, cuts, shared.value, of_all).pack()]})

        return materialize(texts.groupBy("bucket").cogroup(cuts.groupBy("bucket")).applyInPandas(build, "bucket int, data binary"))

    def _fit(self, placed: DataFrame) -> None:
        """Counts endings and fits the shares in rounds, each with what the one before found."""
        session = placed.sparkSession
        of_all = session.range(1).select(_sk(F.lit(ALL)).alias("x")).first()["x"]
        buckets = self._buckets(placed, of_all)
        sizes = self.sizes.select("name", _sk(F.col("name")).alias("sk"), "trust").toPandas()
        trust = Table(sizes["sk"].to_numpy(np.int64), np.where(sizes["name"] == ALL, 0.0, sizes["trust"]))
        names = dict(zip(sizes["sk"], sizes["name"]))

        def over(schema: str, rows: Callable[[Bucket], Iterator[dict]]) -> DataFrame:
            types = [x.split() for x in schema.split(", ")]
            kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for x in batch.column("data"):
                        for d in rows(Bucket.unpack(x.as_py())):
                            yield pa.RecordBatch.from_arrays([pa.array(d[c], kinds[k]) for c, k in types], names=[c for c, _ in types])

            return buckets.mapInArrow(run, schema)

        # The first two levels, of all cuts: by kind, by last word where texts end so, and the rest by what they count.
        scoped = materialize(_scopes(self.first).groupBy("scope", "g0", "g1").agg(F.round(F.sum("i"), 6).alias("i")).where("i > 0"))
        kinds = scoped.groupBy(_sk(F.col("scope")).alias("sk"), F.col("g0").cast("long")).agg(F.sum("i").alias("i"), F.count(F.lit(1)).cast("double").alias("ti")).toArrow().to_pandas()
        kinds.columns = ["sk", "g0", "i", "ti"]
        ends = self.rows.select("g1").distinct()
        below = over("sk long, g1 long, ti double", lambda b: [{"sk": b.z["b_sk"], "g1": b.z["b_g1"], "ti": b.z["ti2"]}]).groupBy("sk", "g1").agg(F.sum("ti").alias("ti"))
        fixed = scoped.join(ends, "g1", "left_semi").select(_sk(F.col("scope")).alias("sk"), F.col("g0").cast("long").alias("g0"), "g1", "i").join(below, ["sk", "g1"], "left").select("sk", "g0", "g1", "i", F.coalesce("ti", F.lit(0.0)).alias("ti")).toArrow().to_pandas()
        of = scoped.where(F.col("scope") == ALL).select("g1", F.col("i").alias("i_all"))
        apart = self.first.join(ends, "g1", "left_anti").join(of, "g1").groupBy(_sk(F.coalesce("source", F.lit(ALL))).alias("sk"), F.col("g0").cast("long").alias("g0"), "i", "i_all").agg(F.sum("i").alias("n")).toArrow().to_pandas()

        history: list[tuple[Levels, Table]] = []
        for _ in range(ROUNDS + 1):
            shared = session.sparkContext.broadcast(history)

            def counted(b: Bucket) -> list[dict]:
                z, w = b.z, b.z["used"] * (1 - b.chance(shared.value))
                return [{"sk": z["u_sk"], "g0": z["u_g0"], "g1": z["u_g1"], "e": np.bincount(z["n1"], w, len(z["u_sk"])), "te": b.counts(w)[0][1]}]

            now = over("sk long, g0 long, g1 long, e double, te double", counted).groupBy("sk", "g0", "g1").agg(F.sum("e").alias("e"), F.sum("te").alias("te")).toArrow().to_pandas()
            levels = Levels(now.merge(fixed, on=["sk", "g0", "g1"], how="outer").fillna(0.0), kinds)
            current = session.sparkContext.broadcast(levels)

            def weighed(b: Bucket) -> list[dict]:
                z, p = b.z, b.chance(shared.value)
                ratio = b.text_ratios(current.value, z["used"] * (1 - p))
                d = pd.DataFrame({"scope": z["scopes"][z["scope"]], "cell": z["cells"][z["cell"]], "mark": z["mark"], "bin": np.round(ratio * BINS).astype(int), "prior": z["prior"]})[z["noticed"] < 0.5]
                d = d.groupby(["scope", "cell", "mark", "bin"], as_index=False).agg(n=("prior", "size"), prior=("prior", "max"))
                own, every = b.cut_ratios(current.value, z["used"] * (1 - p), trust)
                cuts = _binned(z["c_sk"], own, every, z["c_n"], names)
                return [x.assign(cuts=c).to_dict("list") for c, x in ((False, d), (True, cuts))]

            bins = over("cuts boolean, scope string, cell string, mark int, bin int, n double, prior double", weighed).groupBy("cuts", "scope", "cell", "mark", "bin").agg(F.sum("n").alias("n"), F.max("prior").alias("prior")).toArrow().to_pandas()
            # Cuts whose last word no text ends with: known by their counts at the first two levels.
            sk, g0, zero = apart["sk"].to_numpy(np.int64), apart["g0"].to_numpy(np.int64), np.zeros(len(apart))
            alone = []
            for s, i in ((sk, apart["i"].to_numpy(float)), (np.full(len(sk), of_all), apart["i_all"].to_numpy(float))):
                root, by_kind = levels.tables[0].at(s), levels.tables[1].at(_mix(g0, s))
                alone.append(step(*by_kind[:2], *root, 0.0, 0) + step(zero, i, *by_kind, 0.0, 1))
            rest = _binned(sk, drawn(*alone, trust.at(sk)[0]), alone[1], apart["n"].to_numpy(float), names)
            seen = pd.concat([bins.loc[bins["cuts"], ["scope", "bin", "n"]], rest[["scope", "bin", "n"]]]).groupby(["scope", "bin"], as_index=False)["n"].sum()
            self.usual = medians(seen)
            self.verdicts = fit_all_shares(bins[~bins["cuts"]], self.usual)
            history = [*history, (levels, Table(verdict_keys(self.verdicts), self.verdicts["threshold"].to_numpy(float)))]
        self.levels, self.buckets = levels, buckets
        last = session.sparkContext.broadcast(history)

        def cut(b: Bucket) -> list[dict]:
            use = b.z["own"] & (b.chance(last.value) > 0.5)
            return [{"h1": b.z["h1"][use], "h2": b.z["h2"][use]}]

        # A text that one source's evidence finds cut is cut under every source.
        self.cut_texts = materialize(over("h1 long, h2 long", cut).distinct().withColumn("cut", F.lit(True)))

    def judged(self) -> DataFrame:
        """(id, source, cut) of every document with a text."""
        return self.rows.select("id", "source", "h1", "h2").join(self.cut_texts, ["h1", "h2"], "left").select("id", "source", F.coalesce("cut", F.lit(False)).alias("cut"))

    def found(self) -> DataFrame:
        """(id) of every document whose text was cut."""
        return self.judged().where("cut").select("id")

    def rates(self) -> DataFrame:
        """(source, documents, cut, cut_bp) of each source's documents with a text."""
        out = self.judged().groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count_if("cut").alias("cut"))
        return out.withColumn("cut_bp", F.expr("cut * 10000 div documents"))


def _binned(sk: np.ndarray, own: np.ndarray, every: np.ndarray, n: np.ndarray, names: dict[int, str]) -> pd.DataFrame:
    """Counts of cuts by scope and binned ratio: by their source, and by all texts in the scope of all."""
    fine = lambda x: np.round(np.clip(x, -1000, 1000) * FINE).astype(int)
    mine = np.array([names[s] for s in sk], object)
    by = pd.DataFrame({"scope": np.concatenate([mine[mine != ALL], np.full(len(sk), ALL, object)]), "bin": np.concatenate([fine(own)[mine != ALL], fine(every)]), "n": np.concatenate([n[mine != ALL], n])})
    return by.groupby(["scope", "bin"], as_index=False)["n"].sum().assign(cell="", mark=0, prior=0.0)

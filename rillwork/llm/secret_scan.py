"""Secrets by rules and by a randomness test battery.

Base spans: assignments to words like ``token``, access keys, long hexadecimal runs. Beside them, every run of
at least ``SHORTEST`` characters of the encodings is tested, whole and in parts, as a key may stand behind a path: the parts between
``/ + _ -``, and the run without the words and numbers at its ends. The encoding of each (hexadecimal, base32, lower-case
letters and digits, letters, letters and digits, base64) is inferred from its characters, and tests ask whether its symbols
are independent and uniform over that alphabet: chi-squared of symbols and of character classes, runs about the median, and
lag-1 serial correlation, combined by Fisher's method and by the least of them. A candidate that they reject is no secret.

What is left must be unlike ordinary text: with the symbol frequencies of all texts, chi-squared of a string of n ordinary
symbols is about normal with a mean and spread that grow with n, so the chance that ordinary text looks
so uniform shrinks with the length. Benjamini-Hochberg over the candidates of all documents keeps the share of ordinary
strings among the reported ones below ``FALSE``; runs and parts all count as candidates. A part is not reported beside the run it is part of. The threshold comes from counts of p-values by
``BINS`` logarithmic bins, rounded up, so no p-value is collected or sorted in one place.

Defined results: a null text is an empty one, without spans. Spans are in code points, end exclusive. A candidate that
overlaps a base span is not added. Rows with equal texts get equal spans; doc_id may be null. Other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm.keep import kept, small_batches

KINDS = ("assign", "access", "hex")
ADDED = "random"
SHORTEST = 20
RANDOM = 0.01  # combined p-value below which a candidate is not random
FALSE = 0.01  # expected share of ordinary strings among those reported
BINS = 50  # bins of p-values per power of ten
LEAST_P = -200.0  # powers of ten below which p-values are not told apart

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}" % SHORTEST)
_PART = re.compile(r"[A-Za-z0-9]+")
_PLAIN = re.compile(r"[A-Z]?[a-z]*|[A-Z]+|[0-9]+")
NEVER = 1 << 30  # a bin above all
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: From the smallest alphabet to the greatest: a candidate has the first that holds all its characters.
ENCODINGS = {
    "hex": _DIGITS + "abcdef", "HEX": _DIGITS + "ABCDEF", "base32": _UPPER + "234567", "base36": _LOWER + _DIGITS, "BASE36": _UPPER + _DIGITS,
    "base52": _UPPER + _LOWER, "base62": _UPPER + _LOWER + _DIGITS, "base64": _UPPER + _LOWER + _DIGITS + "+/", "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
_SETS = {name: frozenset(signs) for name, signs in ENCODINGS.items()}
_PLACES = {name: {c: i for i, c in enumerate(signs)} for name, signs in ENCODINGS.items()}


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of each of ``KINDS``, leftmost and not overlapping within a kind."""
    return [[m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= 6], [m.span() for m in _ACCESS.finditer(text)],
            [m.span() for m in _HEX.finditer(text)]]


def encoding_of(run: str) -> str | None:
    """The smallest encoding of a run; None for digits alone and letters of one case alone, which are numbers and words."""
    signs = set(run)
    if not signs - set(_DIGITS) or not signs & set(_DIGITS) and not (signs & set(_LOWER) and signs & set(_UPPER)):
        return None
    return next((name for name, known in _SETS.items() if signs <= known), None)


def upper_tail(x: float) -> float:
    """Chance of a standard normal value of at least ``x``."""
    return 0.5 * math.erfc(x / math.sqrt(2))


def chi_squared(values: np.ndarray, size: int) -> float:
    counts, expected = np.bincount(values, minlength=size), len(values) / size
    return float(((counts - expected) ** 2).sum() / expected)


def class_p(run: str, name: str) -> float:
    """Chi-squared p-value of the counts of upper-case, lower-case, digits and others, against their shares of the alphabet."""
    kinds = {"u": str.isupper, "l": str.islower, "d": str.isdigit, "o": lambda c: not c.isalnum()}
    shares = {k: sum(map(test, ENCODINGS[name])) / len(ENCODINGS[name]) for k, test in kinds.items()}
    shares = {k: v for k, v in shares.items() if v}
    chi = sum((sum(map(kinds[k], run)) - len(run) * v) ** 2 / (len(run) * v) for k, v in shares.items())
    degrees = len(shares) - 1
    if degrees == 0:
        return 1.0
    if degrees == 2:
        return math.exp(-chi / 2)
    return math.erfc(math.sqrt(chi / 2)) + (math.sqrt(2 * chi / math.pi) * math.exp(-chi / 2) if degrees == 3 else 0.0)


def battery(run: str, name: str) -> tuple[float, float]:
    """(chi-squared, combined p-value) of a run in an encoding against independent uniform symbols."""
    values, size = np.array([_PLACES[name][c] for c in run]), len(ENCODINGS[name])
    n = len(values)
    chi = chi_squared(values, size)
    # exact mean and variance under uniform symbols, as few are expected of each
    spread = math.sqrt(2 * (size - 1) * (n - 1) / n)
    p_chi = upper_tail((chi - (size - 1)) / spread)
    high = values * 2 >= size
    a = int(high.sum())
    b = n - a
    p_runs = p_serial = 0.0
    if a and b:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * a * b / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = 2 * upper_tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0
        x = values - values.mean()
        r = float((x[1:] * x[:-1]).sum() / (x * x).sum())
        p_serial = 2 * upper_tail(abs(r + 1 / n) * math.sqrt(n))
    tests = (p_chi, class_p(run, name), p_runs, p_serial)
    half = -sum(math.log(max(p, 1e-300)) for p in tests)  # half of Fisher's statistic, of eight degrees of freedom
    fisher = math.exp(-half) * (1 + half + half**2 / 2 + half**3 / 6)
    return chi, min(fisher, len(tests) * min(tests))


def log_p_ordinary(chi: float, n: int, size: int, excess: float) -> float:
    """log10 of the chance that n ordinary symbols have a chi-squared of at most ``chi``.

    ``excess`` is size * (chance that two ordinary symbols are equal) - 1.
    """
    mean = (size - 1) + (n - 1) * excess
    spread = math.sqrt(2 * (size - 1) + 4 * n * excess)
    z = (mean - chi) / spread
    if z < 8:
        return math.log10(max(upper_tail(z), 1e-300))
    return max(LEAST_P, (-z * z / 2 - math.log(z * math.sqrt(2 * math.pi))) / math.log(10))


def frequencies(docs: DataFrame) -> dict[str, float]:
    """For each encoding the ``excess`` of ordinary text, from the characters of all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, dtype=np.int64)
        for batch in batches:
            texts = pc.drop_null(batch.column(0)).cast(pa.large_string())
            _, offsets, data = texts.buffers()
            if data is not None and len(texts):
                at = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
                total += np.bincount(np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], ["code", "n"])

    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    seen = {r["code"]: r["n"] for r in counts.collect()}  # 256 rows
    out = {}
    for name, signs in ENCODINGS.items():
        n = np.array([seen.get(ord(c), 0) for c in signs], dtype=float)
        p = n / n.sum() if n.sum() else np.full(len(signs), 1 / len(signs))
        out[name] = max(0.0, float(len(signs) * (p * p).sum() - 1))
    return out


def parts_of(run: str) -> list[tuple[int, int]]:
    """What is tested of a run beside the whole: it without plain words and numbers at its ends, and what stands between its signs."""
    parts = [m.span() for m in _PART.finditer(run)]
    odd = [s for s in parts if not _PLAIN.fullmatch(run, *s)]
    found = {s for s in parts if s[1] - s[0] >= SHORTEST}
    if odd and odd[-1][1] - odd[0][0] >= SHORTEST:
        found.add((odd[0][0], odd[-1][1]))
    return sorted(found - {(0, len(run))}, key=lambda s: (s[0], -s[1]))


def candidates(text: str, taken: list[tuple[int, int]], excess: dict[str, float]) -> list[dict]:
    """Runs and parts of runs outside ``taken`` that the battery takes for random, with the bin of their p-value as ordinary text.

    ``outer`` is the least bin of the candidates that a part lies in, so that it is not reported beside them.
    """
    found: list[dict] = []
    for m in _RUN.finditer(text):
        begin, run, here = m.start(), m[0], len(found)
        for a, b in [(0, len(run)), *parts_of(run)]:
            start, end, part = begin + a, begin + b, run[a:b]
            name = encoding_of(part)
            if name is None or any(x < end and start < y for x, y in taken):
                continue
            chi, p = battery(part, name)
            if p >= RANDOM:
                outer = min((g["bin"] for g in found[here:] if g["start"] <= start and end <= g["end"]), default=NEVER)
                found.append({"start": start, "end": end, "outer": outer,
                              "bin": math.ceil(log_p_ordinary(chi, len(part), len(ENCODINGS[name]), excess[name]) * BINS)})
    return found


def scanned(docs: DataFrame) -> DataFrame:
    """Base spans and random-looking candidates of every row."""
    small_batches(docs.sparkSession)
    excess = frequencies(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
        guess = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("bin", pa.int32()), ("outer", pa.int32())])
        for batch in batches:
            counts, shas, bases, guesses = [], [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                spans = base_spans(text)
                base = sorted((a, k, b) for k, found in enumerate(spans) for a, b in found)
                counts.append([len(s) for s in spans])
                shas.append(hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base).encode()).hexdigest())
                bases.append([{"start": a, "kind": k, "end": b} for a, k, b in base])
                guesses.append(candidates(text, [(a, b) for a, _, b in base], excess))
            n = np.array(counts, dtype=np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(n[:, i]) for i in range(3)), pa.array(shas, pa.string()), pa.array(bases, pa.list_(span)),
                 pa.array(guesses, pa.list_(guess))], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "guesses"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, base array<struct<start: int, kind: int, end: int>>, "
             "guesses array<struct<start: int, end: int, bin: int, outer: int>>")


def threshold(bins: dict[int, int]) -> int:
    """The greatest bin up to which Benjamini-Hochberg rejects; below all bins if it rejects none."""
    tests, below, best = sum(bins.values()), 0, int(LEAST_P * BINS) - 1
    for b in sorted(bins):
        below += bins[b]
        if 10 ** (b / BINS) <= FALSE * below / tests:
            best = b
    return best


def found(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) of every row of ``docs`` (doc_id, text)."""
    scan = kept(scanned(docs))
    bins = scan.select(F.explode("guesses.bin").alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
    limit = threshold({r["bin"]: r["n"] for r in bins.collect()})  # a bounded number of bins
    more = F.transform(F.filter("guesses", lambda g: (g["bin"] <= limit) & (g["outer"] > limit)), lambda g: F.struct(
        g["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), g["end"].alias("end")))
    names = F.array(*[F.lit(k) for k in (*KINDS, ADDED)])
    spans = F.array_join(F.transform(F.array_sort(F.concat("base", "more")), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    return scan.withColumn("more", more).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", spans.alias("spans"),
                                                F.size("more").cast("long").alias("n_random"))

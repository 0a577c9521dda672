"""Personal data by rules and by bootstrapped contextual extraction.

Base spans (email, ip, card, phone) are found by rules and are the seeds. The words
around a seed make lexical patterns: the two before it, the two after it, one on each
side. The same patterns are taken around other identifier-like tokens. Spark scores the
graph of patterns and instances in rounds: a pattern is as good as the share
of its occurrences that are good instances, an instance as good as its patterns together. Unseen
tokens in patterns of high confidence, induced by ``SEEDS`` different seeds at least, are added as kind ``context``.

A second pass takes whatever stands in the slots of patterns with enough seeds, any word and any group of numbers joined
by spaces, brackets or hyphens. All that stands in the slots of a pattern counts against its confidence there: the share of
seeds and of instances the graph added must be ``CONFIDENT``. Slots are counted and looked up in the texts by a table of
pattern hashes of fixed size (``SLOTS``); what collides there is put right by a join on the pattern itself. What the second pass
adds does not make patterns better.

Edges are counted per (pattern, instance) before they are joined, and only patterns that have both enough
seeds and unseen instances take part, so frequent words do not gather occurrences in one task.

Defined results: a null text is an empty one, with no spans. Spans are in code points, end exclusive.
Rows with equal doc_id and text get equal spans; doc_id may be null. Other columns are not looked
at, and ``redacted`` hands them on.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm import slots
from rillwork.llm.keep import kept, small_batches

KINDS = ("email", "ip", "card", "phone")
ADDED = "context"
ROUNDS = 3
SEEDS = 5  # different seeds that a pattern needs
CONFIDENT = 0.7
DOUBT = 1.0  # occurrences of unknown worth that every pattern is given
SLOTS = 1 << 24  # places of the table of pattern hashes
HELD = 100_000  # patterns counted in a task before they are handed on

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){12,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)\S*[0-9@]\S*")
_GROUP = re.compile(r"(?<!\S)[(\[]*[0-9][0-9()\[\]/.-]*+(?:\x20{1,2}[(\[]*[0-9][0-9()\[\]/.-]*+)+(?![^\s\"',;:!?])")
_WORD = re.compile(r"\S+")
_TRIM = "\"'.,;:!?()[]{}<>*#$&%"
_TRIMMED = np.array([chr(c) in _TRIM for c in range(128)] + [False])

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return found


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[list[Span]]:
    """Spans of each of ``KINDS``, leftmost and not overlapping within a kind."""
    ips = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    cards = []
    for m in _CARD.finditer(text):
        digits = digits_of(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            cards.append(m.span())
    phones = [m.span() for m in _PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return [emails(text), ips, cards, phones]


def tokens_like(text: str, taken: list[Span]) -> list[Span]:
    """Identifier-like tokens outside ``taken``: four digits at least, or an @."""
    found = []
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        while start < end and text[start] in _TRIM:
            start += 1
        while end > start and text[end - 1] in _TRIM:
            end -= 1
        token = text[start:end]
        if (len(digits_of(token)) >= 4 or "@" in token[1:-1]) and not any(a < end and start < b for a, b in taken):
            found.append((start, end))
    return found


class Words:
    """The words of a text: what stands between white space, cut where a base span begins or ends, and the base spans themselves."""

    def __init__(self, text: str, taken: list[Span]):
        self.text, self.taken = text, []
        for a, b in sorted(taken):
            if self.taken and a < self.taken[-1][1]:
                self.taken[-1] = (self.taken[-1][0], max(b, self.taken[-1][1]))
            else:
                self.taken.append((a, b))
        self.spans: list[Span] = []
        at = 0
        for a, b in [*self.taken, (len(text), len(text))]:
            self.spans += [m.span() for m in _WORD.finditer(text, at, a)]
            if a < b:
                self.spans.append((a, b))
            at = b
        self.starts = [a for a, _ in self.spans]
        self.plain = [text[a:b].strip(_TRIM).lower() for a, b in self.spans]

    def patterns(self, span: Span) -> list[str]:
        """Lexical patterns of a span, from the whole words beside it in lower case without outer signs."""
        start, end = span
        i, j = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        return self.around(start, end, i, j)

    def around(self, start: int, end: int, i: int, j: int) -> list[str]:
        """The patterns of a span that begins in word i and ends in word j."""
        plain = self.plain
        left, right = plain[max(0, i - 2):i], plain[j + 1:j + 3]
        if self.spans[i][0] < start:
            left = [*left, self.text[self.spans[i][0]:start].strip(_TRIM).lower()][-2:]
        if end < self.spans[j][1]:
            right = [self.text[end:self.spans[j][1]].strip(_TRIM).lower(), *right][:2]
        made = []
        if len(left) == 2:
            made.append(f"{left[0]} {left[1]} _")
        if len(right) == 2:
            made.append(f"_ {right[0]} {right[1]}")
        if left and right:
            made.append(f"{left[-1]} _ {right[0]}")
        return [p for p in made if any(map(str.isalpha, p))]

    @classmethod
    def near(cls, text: str, spans: list[Span]) -> Words:
        """These words of a text alone, none of them a base span."""
        words = cls.__new__(cls)
        words.text, words.taken, words.spans, words.starts = text, [], spans, [a for a, _ in spans]
        words.plain = [text[a:b].strip(_TRIM).lower() for a, b in spans]
        return words

    def slots(self, table: bytes) -> Iterator[tuple[int, int, bool, list[str]]]:
        """(start, end, whether a base span, patterns in ``table``) of what stands in their slots: base spans, groups of numbers, other words."""
        plain, crc, n = self.plain, zlib.crc32, len(self.plain)
        text, spans, seeds = self.text, self.spans, set(self.taken)
        groups = iter([m.span() for m in _GROUP.finditer(text)])
        group, i = next(groups, None), 0
        while i < len(spans):
            start, end = spans[i]
            while group and group[0] < start:
                group = next(groups, None)
            if 1 < i < n - 2 and len(plain[i]) == end - start and not (group and group[0] == start):
                # a word without outer signs: most words end here
                a, b, c, d = plain[i - 2], plain[i - 1], plain[i + 1], plain[i + 2]
                made = [p for p in (f"{a} {b} _", f"_ {c} {d}", f"{b} _ {c}") if table[crc(p.encode()) % SLOTS]]
                if made:
                    yield start, end, (start, end) in seeds, made
                i += 1
                continue
            j = i
            seed = (start, end) in seeds
            if group and group[0] == start and not seed:
                last = bisect_right(self.starts, group[1] - 1) - 1
                if not any(s in seeds for s in spans[i:last + 1]):
                    start, end = bracketed(text, group)
                    j = last
            if not seed and j == i:
                while start < end and text[start] in _TRIM:
                    start += 1
                while end > start and text[end - 1] in _TRIM:
                    end -= 1
            made = [p for p in self.around(start, end, i, j) if table[crc(p.encode()) % SLOTS]]
            if made:
                yield start, end, seed, made
            i = j + 1


Found = Iterator[tuple[int, int, bool, list[str]]]


def slots_of(text: str, table: bytes, bits: np.ndarray) -> Found:
    """What ``Words.slots`` gives for the text. Texts without base spans and groups of numbers, nearly all, are looked through with
    arrays first (``bits``), and only words that may be in a slot are compared; others are walked word by word."""
    taken = [s for found in base_spans(text) for s in found]
    lowered = text.lower()
    # the array form needs lower case sign by sign, which a final sigma and a few long forms do not have
    if taken or len(lowered) != len(text) or "\u03a3" in text or _GROUP.search(text):
        yield from Words(text, taken).slots(table)
        return
    view = slots.Windows(text, lowered, _TRIMMED)
    for i in view.candidates(bits).tolist():
        low = max(0, i - 2)
        near = Words.near(text, list(zip(view.begin[low:i + 3].tolist(), view.end[low:i + 3].tolist())))
        start, end = int(view.start[i]), int(view.stop[i])
        made = [p for p in near.around(start, end, i - low, i - low) if table[zlib.crc32(p.encode()) % SLOTS]]
        if made:
            yield start, end, False, made


def bracketed(text: str, span: Span) -> Span:
    """A group of numbers without the signs outside it; brackets that are a pair inside it stay."""
    start, end = span
    while text[end - 1] in ".-/" or text[end - 1] in ")]" and text.count(text[end - 1], start, end) > text.count("(["[text[end - 1] == "]"], start, end):
        end -= 1
    while text[start] in "([" and text.count(text[start], start, end) > text.count(")]"[text[start] == "["], start, end):
        start += 1
    return start, end


def written(spans: list[list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, found in zip(KINDS, spans) for a, b in found)


_FIRST = ("doc_id long, text_hash long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
          "seen array<struct<instance: binary, seed: boolean, start: int, end: int, patterns: array<string>>>")


def scanned(docs: DataFrame) -> DataFrame:
    """Base spans of every row and the patterns around all seeds and identifier-like tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen_type = pa.list_(pa.struct([("instance", pa.binary()), ("seed", pa.bool_()), ("start", pa.int32()), ("end", pa.int32()),
                                        ("patterns", pa.list_(pa.string()))]))
        for batch in batches:
            counts, shas, bases, seen = [], [], [], []
            for value in batch.column(2):
                text = value.as_py()
                spans = base_spans(text)
                base = written(spans)
                taken = [s for found in spans for s in found]
                like = tokens_like(text, taken)
                nodes, words = [], Words(text, taken) if taken or like else None
                for seed, found in ((True, taken), (False, like)):
                    for a, b in found:
                        made = words.patterns((a, b))
                        if made:
                            nodes.append({"instance": hashlib.blake2b(text[a:b].lower().encode(), digest_size=8).digest(),
                                          "seed": seed, "start": a, "end": b, "patterns": made})
                counts.append([len(s) for s in spans])
                shas.append(hashlib.sha256(base.encode()).hexdigest())
                bases.append(base)
                seen.append(nodes)
            n = np.array(counts, dtype=np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(n[:, i]) for i in range(4)), pa.array(shas, pa.string()), pa.array(bases, pa.string()),
                 pa.array(seen, seen_type)],
                ["doc_id", "text_hash", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "seen"])

    return keyed(docs).mapInArrow(run, _FIRST)


def keyed(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def trusted(seen: DataFrame) -> DataFrame:
    """(pattern, confidence) of the patterns to trust, from (pattern, instance, seed) occurrences."""
    edges = seen.groupBy("pattern", "instance", "seed").agg(F.count("*").alias("n"))
    useful = edges.groupBy("pattern").agg(F.sum(F.col("seed").cast("long")).alias("seeds"), F.sum((~F.col("seed")).cast("long")).alias("unseen")).where(
        (F.col("seeds") >= SEEDS) & (F.col("unseen") > 0)).select("pattern")
    edges = kept(edges.join(useful, "pattern"))
    worth = edges.select("instance", "seed").distinct().select("instance", F.col("seed").cast("double").alias("worth"))
    worth = worth.groupBy("instance").agg(F.max("worth").alias("worth"))
    for _ in range(ROUNDS):
        scored = edges.join(worth, "instance").groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("worth")) / (F.sum("n") + DOUBT)).alias("confidence"))
        known = edges.where("seed").select("instance").distinct().withColumn("given", F.lit(1.0))
        missed = edges.select("pattern", "instance").distinct().join(scored, "pattern").groupBy("instance").agg(
            F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))).alias("missed"))
        worth = kept(missed.join(known, "instance", "left").select(
            "instance", F.coalesce("given", 1 - F.exp("missed")).alias("worth")))
    return scored.where(F.col("confidence") >= CONFIDENT)


def table_of(patterns: DataFrame) -> bytes | None:
    """For each place of ``SLOTS`` whether a pattern has it as its hash; None without patterns."""
    place = F.crc32(F.encode("pattern", "utf-8")) % SLOTS
    words = patterns.select(F.shiftright(place, 5).alias("at"), (place % 32).cast("int").alias("bit")).groupBy("at").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()  # SLOTS / 32 rows at most
    if not words.num_rows:
        return None
    table = np.zeros(SLOTS // 32, dtype="<u4")
    table[words["at"].to_numpy()] = words["bits"].to_numpy().astype("<u4")
    return np.unpackbits(table.view(np.uint8), bitorder="little").tobytes()


def in_slots(docs: DataFrame, table: bytes, bits: np.ndarray) -> DataFrame:
    """(pattern, n): how often anything stands in the slots of the patterns of ``table``, in parts."""
    known = docs.sparkSession.sparkContext.broadcast((table, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (table, bits), n = known.value, Counter()

        def counted() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], ["pattern", "n"])
            n.clear()
            return made

        for batch in batches:
            for value in batch.column(2):
                for *_, made in slots_of(value.as_py(), table, bits):
                    n.update(made)
                if len(n) >= HELD:
                    yield counted()
        yield counted()

    return keyed(docs).mapInArrow(run, "pattern string, n long")


def standing(docs: DataFrame, table: bytes, bits: np.ndarray) -> DataFrame:
    """(doc_id, text_hash, start, end, pattern) of what is no base span in the slots of the patterns of ``table``."""
    known = docs.sparkSession.sparkContext.broadcast((table, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bits = known.value
        for batch in batches:
            rows, starts, ends, patterns = [], [], [], []
            for row, value in enumerate(batch.column(2)):
                for start, end, seed, made in slots_of(value.as_py(), table, bits):
                    for p in made if start < end and not seed else ():
                        rows.append(row)
                        starts.append(start)
                        ends.append(end)
                        patterns.append(p)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()),
                                              pa.array(patterns, pa.string())], ["doc_id", "text_hash", "start", "end", "pattern"])

    return keyed(docs).mapInArrow(run, "doc_id long, text_hash long, start int, end int, pattern string")


def second(docs: DataFrame, seen: DataFrame, good: DataFrame) -> DataFrame | None:
    """Spans of all that stands in the slots of patterns that hold seeds and instances of ``good`` patterns nearly always."""
    instances = seen.where("NOT seed").join(good, "pattern").select("instance").distinct().withColumn("good", F.lit(True))
    counted = seen.join(instances, "instance", "left").groupBy("pattern", "instance").agg(
        F.max("seed").alias("seed"), F.count_if(F.col("seed") | F.col("good")).alias("good"))
    seeded = kept(counted.groupBy("pattern").agg(F.count_if("seed").alias("seeds"), F.sum("good").alias("good")).where(F.col("seeds") >= SEEDS))
    table = table_of(seeded)
    if table is None:
        return None
    total = in_slots(docs, table, slots.bits_of(seeded)).groupBy("pattern").agg(F.sum("n").alias("n"))
    sure = kept(seeded.join(total, "pattern").where(
        F.col("good") / (F.col("n") + DOUBT) >= CONFIDENT).select("pattern"))
    table = table_of(sure)
    if table is None:
        return None
    return standing(docs, table, slots.bits_of(sure)).join(sure, "pattern").select("doc_id", "text_hash", "start", "end")


def added(docs: DataFrame, scan: DataFrame) -> DataFrame:
    """(doc_id, text_hash, more): the spans that trusted patterns add, as an array of (start, end)."""
    seen = scan.select("doc_id", "text_hash", F.explode("seen").alias("s")).select("doc_id", "text_hash", "s.*").withColumn("pattern", F.explode("patterns"))
    good = kept(trusted(seen.select("pattern", "instance", "seed")))
    spans = seen.where("NOT seed").join(good, "pattern").select("doc_id", "text_hash", "start", "end")
    more = second(docs, seen.select("pattern", "instance", "seed"), good)
    spans = (spans if more is None else spans.union(more)).distinct()
    return kept(spans.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("more")).mapInArrow(
        united, "doc_id long, text_hash long, more array<struct<start: int, end: int>>"))


def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that overlap become one."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        more = []
        for spans in batch.column(2).to_pylist():
            apart: list[dict] = []
            for s in spans:
                if apart and s["start"] < apart[-1]["end"]:
                    apart[-1]["end"] = max(apart[-1]["end"], s["end"])
                else:
                    apart.append(s)
            more.append(apart)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(more, kind)], ["doc_id", "text_hash", "more"])


def joined(rows: DataFrame, more: DataFrame) -> DataFrame:
    more = more.withColumnsRenamed({"doc_id": "doc_", "text_hash": "hash_"})
    return rows.join(more, F.col("doc_id").eqNullSafe(F.col("doc_")) & (F.col("text_hash") == F.col("hash_")), "left").drop("doc_", "hash_")


def found(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row of ``docs`` (doc_id, text)."""
    scan = kept(scanned(docs))
    extra = F.transform("more", lambda s: F.concat_ws(":", F.lit(ADDED), s["start"].cast("string"), s["end"].cast("string")))
    parts = F.filter(F.concat(F.array("base"), F.coalesce(extra, F.array().cast("array<string>"))), lambda p: p != "")
    return joined(scan, added(docs, scan)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", F.array_join(parts, ",").alias("spans"))


def masked(text: str, more: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first names the kind."""
    spans = sorted([(a, b, kind) for kind, found in zip(KINDS, base_spans(text)) for a, b in found] + [(a, b, ADDED) for a, b in more],
                   key=lambda s: (s[0], -s[1]))
    out, end = [], 0
    for a, b, kind in spans:
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text``; ``n_chars``, if there, follows a text that changed."""
    more = added(docs, kept(scanned(docs)))
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select([F.col(c).alias(n) for c, n in names.items()])
    text = F.coalesce(F.col(names["text"]).cast("string"), F.lit(""))
    rows = joined(renamed.withColumn("doc_id", F.col(names["doc_id"]).cast("long")).withColumn("text_hash", F.xxhash64(text)), more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = []
            for text, more in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new.append(None if text is None else masked(text, [(s["start"], s["end"]) for s in more or []]))
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()), *batch.columns[2:]], ["new", *names.values()])

    kinds = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in names.items())
    done = rows.select(F.col(names["text"]).cast("string").alias("old"), "more", *names.values()).mapInArrow(run, f"new string, {kinds}")
    values = {c: F.col(n) for c, n in names.items()} | {"text": F.col("new")}
    if "n_chars" in values:
        values["n_chars"] = F.when(F.col("new") != F.col(names["text"]), F.length("new")).otherwise(F.col(names["n_chars"])).cast(docs.schema["n_chars"].dataType)
    return done.select([values[c].alias(c) for c in docs.columns])

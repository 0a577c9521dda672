"""Language identification by compression.

Each language has a raw-content Zstandard dictionary: letters of a bounded sample of
labelled texts. A text is compressed once with every dictionary, and the one
that makes it smallest names the language. Code lengths are compared in bits,
and a language costs -log2 of its share of all labelled documents, which decides
between equal sizes. A text is rejected if it is long enough to tell and the margin
between the two best is narrow.

Bounds of the sample (``SAMPLE`` texts, of each a slice of ``SLICE`` characters at a place that a hash of the text
chooses, and ``DICTIONARY`` bytes) apply to the dictionaries only; every
text is classified whole, in pieces of ``PIECE`` bytes.

Defined results: ``und`` with score 0 and rejected for a null text or one without a
letter, and for every text if nothing is labelled. Labels are any strings; a null label
teaches nothing. doc_id, source and label are never inputs of a prediction.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillwork.llm.keep import small_batches

UNKNOWN = "und"
SAMPLE = 300  # labelled texts of a language that may go into its dictionary
DICTIONARY = 65536  # bytes of a dictionary
SLICE = DICTIONARY // 16  # characters of a sampled text
PIECE = 16384  # bytes compressed at once
LEVEL = 6
NARROW = 0.002  # of the smallest size
TELLING = 200  # bytes from which a narrow margin rejects

_NO_LETTER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> bytes:
    """The words of a text in lower case, letters only."""
    plain = _NO_LETTER.sub(" ", text.lower()).strip() if text else ""
    # numerals such as superscripts are word characters but no letters
    return plain.encode("utf-8", "ignore") if any(map(str.isalpha, plain)) else b""


def learned(labelled: DataFrame) -> dict[str, tuple[bytes, float]]:
    """Language: (dictionary, bits that naming it costs), from (doc_id, text, lang).

    Counts are over all labelled documents. The sample are the documents of a language with the
    smallest hashes; the driver gets at most ``SAMPLE`` pieces of text of each.
    """
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col("text")), F.lit(2**52))
    found = labelled.groupBy("lang").agg(F.count("*").alias("n"), F.min(place).alias("least")).collect()
    counts, least = {r["lang"]: r["n"] for r in found}, {r["lang"]: r["least"] for r in found}
    # a share of each language by hash that leaves a few times the sample, so that no task ranks a whole language; few different
    # rows may all lie outside the share, so the smallest hash is always in
    shares = {lang: min(1.0, 4 * SAMPLE / n) for lang, n in counts.items() if n > 4 * SAMPLE}
    few = labelled.select("lang", "text", place.alias("place"))
    if shares:
        until = F.create_map(*[F.lit(v) for lang, share in shares.items() for v in (lang, max(share * 2**52, least[lang] + 1.0))])[F.col("lang")]
        few = few.where(F.col("place") < F.coalesce(until, F.lit(float(2**52))))
    by = Window.partitionBy("lang").orderBy("place", "text")
    begin = 1 + F.pmod(F.hash("text"), F.greatest(F.lit(1), F.length("text") - SLICE + 1))
    sample = (few.select("lang", "place", F.col("text").substr(begin, F.lit(SLICE)).alias("text"))
              .withColumn("k", F.row_number().over(by)).where(F.col("k") <= SAMPLE).select("lang", "k", "text"))
    parts: dict[str, list] = {lang: [] for lang in counts}
    for r in sample.collect():
        parts[r["lang"]].append((r["k"], letters(r["text"])))
    total = sum(counts.values())
    out = {}
    for lang in sorted(counts):
        texts, size = [], 0
        for _, text in sorted(parts[lang]):
            texts.append(text)
            size += len(text) + 1
            if size >= DICTIONARY:
                break
        out[lang] = (b" ".join(texts)[-DICTIONARY:], -math.log2(counts[lang] / total))
    return out


class Classifier:
    def __init__(self, model: dict[str, tuple[bytes, float]]):
        def compressor(content: bytes) -> zstandard.ZstdCompressor:
            given = {"dict_data": zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)} if len(content) >= 8 else {}
            return zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False, **given)

        self.languages = [(lang, compressor(content), bits) for lang, (content, bits) in model.items()]

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score from 0 to 1, rejected)."""
        plain = letters(text)
        if not plain or not self.languages:
            return UNKNOWN, 0.0, True
        pieces = [plain[a:a + PIECE] for a in range(0, len(plain), PIECE)]
        sizes = sorted((8 * sum(len(z.compress(p)) for p in pieces) + bits, lang) for lang, z, bits in self.languages)
        best, lang = sizes[0]
        if len(sizes) == 1:
            return lang, 1.0, False
        margin = sizes[1][0] - best
        # the odds that the code lengths imply, for one bit in eight, as sizes are whole bytes
        score = 1 / (1 + 2.0 ** -min(margin / 8, 60))
        return lang, score, len(plain) >= TELLING and margin < NARROW * best


def identified(docs: DataFrame, model: dict[str, tuple[bytes, float]], *carried: str) -> DataFrame:
    """``carried`` columns of every row of ``docs`` with lang_pred, score and rejected, from its text only."""
    small_batches(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(model)  # at most DICTIONARY bytes a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(known.value)
        for batch in batches:
            found = [classify(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[2] for f in found], pa.bool_())], [*carried, "lang_pred", "score", "rejected"])

    rows = docs.select(F.col("text").cast("string").alias("text_"), *carried)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, f"{kinds}{', ' if kinds else ''}lang_pred string, score double, rejected boolean")


def held_out(doc_id: str) -> Column:
    """Documents nothing is learned from: crc32 of the id as text leaves 2 after division by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predictions(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row of ``docs`` (doc_id, text, lang)."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    found = identified(docs.withColumn("held_out", held_out("doc_id")), learned(docs.where(~held_out("doc_id"))), "doc_id", "held_out")
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language can be told; learned from the same rows as ``predictions``."""
    labelled = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(~held_out("doc_id"))
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(F.col("text"), *[F.col(c).alias(n) for c, n in names.items()])
    told = identified(plain, learned(labelled), *names.values()).where("NOT rejected")
    return told.select(*[F.col(n).alias(c) for c, n in names.items()])

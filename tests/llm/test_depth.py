"""Cases beyond the small tables: keys inside paths, very long words, sampled slices, and slots by arrays beside slots word by word."""

import random
import string
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rillwork.llm import fingerprints, langid, pii, secret_scan, slots, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
PREFIXES = ["", "/srv/app/config/keys/", "/srv/my_app/", "a/b-c/", "https://example.com/v1/"]


def keys(signs, n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(signs) for _ in range(40)) for _ in range(n)]


@pytest.mark.parametrize("signs", [string.ascii_letters + string.digits, string.ascii_letters, string.ascii_lowercase + string.digits])
@pytest.mark.parametrize("prefix", PREFIXES)
def test_keys_behind_paths_are_candidates(prefix, signs):
    excess = {name: 0.7 for name in secret_scan.ENCODINGS}
    found = 0
    for key in keys(signs, 300, 11):
        at = 4 + len(prefix)
        guesses = secret_scan.candidates(f"use {prefix}{key} here", [], excess)
        found += any(g["start"] <= at and g["end"] == at + 40 for g in guesses)
    assert found >= 0.9 * 300


def test_keys_with_signs_behind_paths(spark):
    """Base64 keys, whose own slashes divide them, are found at least in part; plain paths are not reported."""
    rng = random.Random(5)
    prose = [(i, " ".join(rng.choice(["some", "ordinary", "words", "that", "people", "write", "every", "day"]) for _ in range(80))) for i in range(200)]
    plain = [(5000 + i, t) for i, t in enumerate([
        "see /usr/share/python3/dist-packages/internationalization/tests here", "getElementsByTagNameAndClassName", "https://example.com/2024/05/17/a-very-long-title-of-a-post",
        "Donaudampfschifffahrtsgesellschaft", "my_very_long_identifier_name_42_again", "THIS_IS_A_LONG_CONSTANT_NAME_1", "123456789012345678901234567890"])]
    rows = prose + plain
    for k, prefix in enumerate(PREFIXES):
        rows += [(1000 * (k + 10) + i, f"use {prefix}{key} here") for i, key in enumerate(keys(string.ascii_letters + string.digits + "+/", 40, k))]
    found = {r.doc_id: r for r in secret_scan.found(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, prefix in enumerate(PREFIXES):
        assert sum(found[1000 * (k + 10) + i].n_random > 0 for i in range(40)) >= 0.8 * 40, prefix
    assert not any(found[d].n_random for d, _ in prose + plain)


def test_parts_know_the_runs_they_lie_in():
    """A part is left out where a candidate around it is reported."""
    excess, inside = {name: 0.7 for name in secret_scan.ENCODINGS}, 0
    several = keys(string.ascii_letters + string.digits + "+/", 300, 3)
    for a, b in zip(several[::2], several[1::2]):
        guesses = secret_scan.candidates(f"use {a}/{b} here", [], excess)
        for i, g in enumerate(guesses):
            around = [o["bin"] for o in guesses if o is not g and o["start"] <= g["start"] and g["end"] <= o["end"]]
            assert g["outer"] == min(around, default=secret_scan.NEVER)
            inside += bool(around)
    assert inside > 20


def test_tokens_of_words_of_millions_of_signs(spark):
    """More than 2**24 tokens in one word: every sign is four bytes and no piece."""
    n = 4_200_000
    model = token_counts.Unigram({token_counts.MARK: -10, "a": -20, "ab": -15})
    assert model.count(["\U0001f600" * n])[0] == 4 * n
    assert model.count_one("ab" * 300) == 300 and model.count_one("") == 0


def test_the_dictionary_is_no_prefix(spark):
    """Texts with one long head in two languages: slices reach behind the head, so the languages are told apart."""
    head = "terms apply " * 800
    words = {"a": ["zum", "haus", "gehen", "kinder", "schule", "morgen"], "b": ["pour", "aller", "maison", "enfants", "demain", "matin"]}
    rng = random.Random(2)

    def body(lang, n):
        return " ".join(rng.choice(words[lang]) for _ in range(n))

    rows = [(i, head + body("ab"[i % 2], 3000), "ab"[i % 2]) for i in range(60)]
    model = langid.learned(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    classify = langid.Classifier(model)
    assert [classify(body(lang, 12))[0] for lang in "abab"] == list("abab")
    assert all(b"terms apply" not in content[-2000:] or words[lang][0].encode() in content for lang, (content, _) in model.items())


def test_a_language_of_few_different_rows_keeps_a_dictionary(spark):
    rows = spark.range(4 * langid.SAMPLE * 3).select(
        F.lit(7).cast("long").alias("doc_id"), F.lit("immer der gleiche text hier").alias("text"), F.lit("de").alias("lang"))
    content, _ = langid.learned(rows)["de"]
    assert b"gleiche" in content


def test_slots_by_arrays_equal_slots_by_word():
    rng = random.Random(1)
    bits_of_text = ["alpha", "Beta", "(gamma)", "delta,", "...", "_", "\"x\"", "É", "straße", "12", "34-56", "a@b.org", "ΣΑΣ", "İx", "　", "\n", " ", " ", "!a", "b!", "1.2.3.4"]
    texts = [" ".join(rng.choice(bits_of_text) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    patterns = set()
    for t in texts:
        words = pii.Words(t, [])
        for i, span in enumerate(words.spans):
            if rng.random() < 0.05:
                patterns.update(words.around(*span, i, i))
    table, bits = bytearray(pii.SLOTS), np.zeros(slots.PLACES, dtype=np.uint8)
    for p in patterns:
        table[zlib.crc32(p.encode()) % pii.SLOTS] = 1
        bits[slots.keys_of(p)] = 1
    table, bits = bytes(table), np.packbits(bits, bitorder="little")

    def known(found):
        return [(a, b, seed, [p for p in made if p in patterns]) for a, b, seed, made in found if patterns & set(made)]

    hits = 0
    for t in texts:
        by_word = known(pii.Words(t, [s for found in pii.base_spans(t) for s in found]).slots(table))
        assert known(pii.slots_of(t, table, bits)) == by_word, t
        hits += len(by_word)
    assert hits > 1000


def test_bits_of_patterns(spark):
    patterns = ["a b _", "_ a b", "a _ b", "_ _ x", " b _", "ä _ "]
    bits = np.unpackbits(slots.bits_of(spark.createDataFrame([(p,) for p in patterns], "pattern string")), bitorder="little")
    assert set(np.flatnonzero(bits).tolist()) == {k for p in patterns for k in slots.keys_of(p)}
    assert slots.bits_of(spark.createDataFrame([], "pattern string")).sum() == 0


def test_places_of_next_documents(spark):
    rows = [(i * 3 % 50, f"text {i}") for i in range(50)] + [(None, "x")]
    placed = fingerprints.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    own = [r for r in placed if not r.lent]
    assert len(own) == 51
    firsts = {}
    for r in own:
        if r.doc_id is not None:
            firsts[r.place] = min(firsts.get(r.place, r.doc_id), r.doc_id)
    assert sorted((r.place, r.doc_id) for r in placed if r.lent) == sorted(((p - 1) % len(firsts), d) for p, d in firsts.items())

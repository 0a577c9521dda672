"""The registered corpus queries over the small tables: beside their SQL, or beside plain loops."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from oracle_check import compare, duck
from rillwork.llm import fingerprints, pii, token_counts
from rillwork.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id").fetchall()


def rows(spark, key):
    return entry.queries()[key](spark, FOLDER).collect()


@pytest.mark.parametrize("key", ORACLES)
def test_query_equals_sql(spark, con, key):
    assert compare(spark, con, FOLDER, key, entry.queries()[key], ORACLES[key]) is None


def test_all_are_registered():
    assert {int(re.match(r"op(\d+)_", key)[1]) for key in QUERIES} == set(range(1, 14))
    assert "pipeline" in entry.queries()


def test_packing(spark, documents):
    found = rows(spark, "op2_cutting_stock_packing")
    check_packing(found, {d: t or "" for d, t, *_ in documents})
    tokens = sum(r.length for r in found)
    assert tokens / (1024 * len({r.sequence_id for r in found})) > 0.97


def check_packing(found, texts):
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    known.encode_special_tokens = True
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for doc_id, parts in pieces.items():
        ids = np.array([*known.encode(texts[doc_id], add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start:at].tobytes())
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_language(spark, documents):
    lang = {d: label for d, _, label, _ in documents}
    found = rows(spark, "op3_compression_langid")
    assert {r.doc_id for r in found} == set(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.95


SECRETS = {"assign": r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
           "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}


def plain_secrets(text):
    keep = {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}
    found = [(m.start(), list(SECRETS).index(k), k, m.end()) for k, p in SECRETS.items() for m in re.finditer(p, text) if keep[k](m)]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


def test_secrets(spark, documents):
    found = {r.doc_id: r for r in rows(spark, "op4_randomness_secret_scan")}
    for doc_id, text, *_ in documents:
        want, r = plain_secrets(text or ""), found[doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == want
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k + ":") for s in want) for k in SECRETS]


PERSONAL = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_personal(text):
    def good(kind, found):
        digits = re.sub(r"[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        return {"email": True, "card": 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]

    return [f"{k}:{m.start()}:{m.end()}" for k, p in PERSONAL.items() for m in re.finditer(p, text) if good(k, m[0])]


def test_personal_data(spark, documents):
    found = {r.doc_id: r for r in rows(spark, "op6_bootstrapped_pii")}
    for doc_id, text, *_ in documents:
        want, r = plain_personal(text or ""), found[doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("context")] == want
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in want) for k in PERSONAL]


def plain_tokens(word, scores):
    best = [(0, 0)]
    for end in range(1, len(word) + 1):
        ways = [(best[end - k][0] + scores[word[end - k:end]], best[end - k][1] - 1) for k in range(1, min(end, 16) + 1) if word[end - k:end] in scores]
        if word[end - 1] not in scores:
            n = len(word[end - 1].encode())
            ways.append((best[end - 1][0] + n * token_counts.BYTE, best[end - 1][1] - n))
        best.append(max(ways))
    return -best[-1][1]


def test_token_counts(spark, documents):
    scores = token_counts.unigram(public_tokenizers.path("piece_bpe_32k.model")).scores
    found = {r.doc_id: r for r in rows(spark, "op7_trie_token_counts")}
    memo = {}
    for doc_id, text, *_ in documents:
        words = (text or "").split()
        for w in words:
            if w not in memo:
                memo[w] = plain_tokens(token_counts.MARK + w, scores)
        assert (found[doc_id].n_words, found[doc_id].n_tokens) == (len(words), sum(map(memo.get, words)))


def test_fingerprints(spark, documents):
    def alike(a, b):
        return sum(a[i:i + 4] == b[i:i + 4] for i in range(0, len(a), 4)) / fingerprints.PERMUTATIONS

    found = {r.doc_id: r for r in rows(spark, "op9_minhash_fingerprints")}
    texts = [(d, t or "") for d, t, *_ in documents]
    for (doc_id, text), (after, other) in zip(texts, texts[1:] + texts[:1]):
        cut, r = len(text) // 4, found[doc_id]
        edited = text[:len(text) - cut] + other[:cut]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == alike(r.fingerprint, r.edited_fingerprint) and r.near_next == alike(r.fingerprint, found[after].fingerprint)
    by_text = defaultdict(set)
    for doc_id, text in texts:
        by_text[text].add(found[doc_id].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def groups(texts, k, percent):
    """Smallest reachable id of every document, by comparing all pairs."""
    sets = {d: shingles(t, k) for d, t in texts}
    label = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_similar_fingerprints(spark, documents):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = groups([(d, t) for d, t, *_ in documents], 5, 80)
    assert {r.doc_id: r.component_id for r in fingerprints.similar(docs).collect()} == {d: c for d, c in want.items() if shingles(dict((d, t) for d, t, *_ in documents)[d], 5)}


def test_pipeline(spark, documents):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(c.STAGES)
    assert [name for name, _ in c.STAGES] == ["language_id", "near_dedup", "pii", "mixing", "packing"]
    told = stages["language_id"](spark, docs, FOLDER)
    assert told.columns == docs.columns and told.count() >= 0.99 * len(documents)
    kept = stages["near_dedup"](spark, docs, FOLDER)
    label = groups([(d, t) for d, t, *_ in documents], 5, 80)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, c in label.items() if d == c)
    clean = stages["pii"](spark, docs, FOLDER)
    texts = {d: t for d, t, *_ in documents}
    for r in clean.collect():
        assert not plain_personal(r.text) and r.n_chars == len(r.text) and (r.text == texts[r.doc_id]) == (not plain_personal(texts[r.doc_id]))
    taken = {r.doc_id: r for r in rows(spark, "op5_pareto_mixing")}
    mixed = Counter()
    for r in stages["mixing"](spark, docs, FOLDER).collect():
        words = (r.text or "").encode().split()
        mixed[r.doc_id] += len(words)
        assert words == texts[r.doc_id].encode().split()[:len(words)] and r.n_chars == len(r.text)
    assert all(mixed[d] == r.taken for d, r in taken.items())
    packed = stages["packing"](spark, docs, FOLDER).collect()
    check_packing(packed, {d: t or "" for d, t, *_ in documents})
    assert c.run(spark, FOLDER).count() > 0

"""The Merkle manifest beside trees built by plain loops."""

import hashlib
import zlib

from pyspark.sql import functions as F

from rillwork.llm import merkle
from rillwork.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, idx string, nodes string, pos string, first string, n string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels_over(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i:i + 16])) for i in range(0, len(below), 16)])
    return levels


def way(levels, i):
    for level in levels[:-1]:
        run = i // 16
        yield "".join(level[16 * run:i]), "".join(level[i + 1:16 * run + 16])
        i = run


def lowered(doc_id, text):
    if doc_id is None or text is None or zlib.crc32(str(doc_id).encode()) % 5:
        return text
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def expected(rows):
    """Sorted result rows, the trees by source and the tree over the sources."""
    by_source = {}
    for doc_id, text, lang, source, n_chars in rows:
        entry = (doc_id is None, doc_id or 0, leaf(doc_id, source, lang, n_chars, text), doc_id, leaf(doc_id, source, lang, n_chars, lowered(doc_id, text)))
        by_source.setdefault(source, []).append(entry)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels_over([e[2] for e in sorted(by_source[s])]) for s in sources]
    top = levels_over([t[-1][0] for t in trees])
    root, out = top[-1][0], []
    for k, s in enumerate(sources):
        for i, (_, _, own, doc_id, changed) in enumerate(sorted(by_source[s])):
            sides = [*way(trees[k], i), *way(top, k)]
            for left, right in sides:
                changed = sha(left + changed + right)
            out.append((doc_id, own, trees[k][-1][0], root, sha("".join(a + b for a, b in sides)), changed, changed == root))
    return sorted(out, key=str), trees, top


def found(made):
    return sorted((tuple(r) for r in made.versions().select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def with_clashes(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)


def test_odd_rows(spark):
    rows = [(1, "Aa", "en", "b", 2), (1, "Aa", "en", "b", 2), (2, None, None, None, None), (None, "Zz", "de", "b", 2), (3, "", "de", "\U0001f600", 0),
            (4, "ÄB " * 70000, "de", "￮", None), (15, "NO", "en", "b", 2), (16, "no", "en", "", 2), *[(i, "Up", "en", "b", 2) for i in range(20, 40)]]
    docs = with_clashes(spark, rows)
    want, _, _ = expected(rows)
    assert found(merkle.tampered(docs)) == want
    assert {r[6] for r in want} == {True, False}


def test_one_leaf_is_its_own_root(spark):
    made = merkle.tampered(with_clashes(spark, [(7, "x", "en", None, 1)]))
    r = made.versions().first()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.verified and r.proof_sha256 == sha("")


def test_no_rows(spark):
    made = merkle.tampered(with_clashes(spark, []))
    assert made.root is None and made.versions().count() == 0 and made.nodes().count() == 0
    assert QUERIES["op11_path_copying_manifest"].__name__ == "op11"


def test_trees_of_several_rounds(spark):
    """One source with more than two rounds of blocks, some at the edges of runs and blocks, and more sources than one run takes."""
    sizes = {"hot": 65600, "a": 16, "b": 17, "c": 256, "d": 257, **{f"s{i}": 1 for i in range(14)}}
    rows, doc_id = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            doc_id += 1
            rows.append((doc_id, f"T{doc_id}", "en", source, 3))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(8)
    want, trees, top = expected(rows)
    made = merkle.tampered(docs)
    assert len(made.rounds) == 3 and found(made) == want
    plain = {(k, level, i): node for k, t in [*enumerate(trees), (-1, top)] for level, nodes in enumerate(t) for i, node in enumerate(nodes)}
    nodes = {(r.tree, r.level, r.idx): r.digest for r in made.nodes().collect()}
    assert nodes == plain
    check_versions(made, nodes, trees, top)


def check_versions(made, nodes, trees, top):
    """A version is its copied nodes and the shared rest: folding any of its runs gives the node above it."""
    places = {r.source: r.tree for r in made.sources.collect()}
    assert sorted(places.values()) == list(range(len(places)))
    for r in made.versions().where(F.col("doc_id") % 9973 == 0).collect():
        tree, height = r.tree, len(trees[r.tree]) - 1

        def at(level, i):
            return r.copied[level] if r.idx >> (4 * level) == i else nodes[(tree, level, i)]

        assert r.copied[0] == r.version_leaf and len(r.copied) == height + len(top)
        for level in range(height):
            run = r.idx >> (4 * level + 4)
            inside = [at(level, i) for i in range(16 * run, 16 * run + 16) if (tree, level, i) in nodes]
            assert sha("".join(inside)) == r.copied[level + 1]


def test_without_changes_all_is_verified(spark):
    rows = [(i, f"T{i}", "en", "a" if i % 3 else None, 1) for i in range(40)]
    made = merkle.manifest(with_clashes(spark, rows))
    assert all(r.verified and r.version_leaf == r.leaf for r in made.versions().collect())

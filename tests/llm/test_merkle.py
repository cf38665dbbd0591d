"""op11 against a plain tree built in Python."""

import hashlib
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from sessionloom.llm import merkle, queries


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v) -> str:
    if v is None:
        return "-"
    s = str(v)
    return f"{len(s.encode())}:{s}"


def leaf_of(r, text=None) -> str:
    return H(*(enc(x) for x in (r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"] if text is None else text)))


def tree(nodes: list[str], arity: int):
    """Levels of one tree; per position of the first level, (left, right) siblings per level and the top."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))  # position of each leaf's ancestor
    while len(nodes) > 1:
        runs = [nodes[k : k + arity] for k in range(0, len(nodes), arity)]
        for leaf, i in enumerate(at):
            run, slot = runs[i // arity], i % arity
            paths[leaf].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            at[leaf] = i // arity
        nodes = [H(*run) for run in runs]
    return paths, nodes[0]


def brute(rows, arity=8):
    tamper = lambda r: r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    subs, inner = {}, {}
    for k in keys:
        members = sorted(groups[k], key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, leaf_of(r)))
        paths, top = tree([leaf_of(r) for r in members], arity)
        subs[k], inner[k] = top, list(zip(members, paths))
    upper, root = tree([subs[k] for k in keys], arity)
    out = []
    for n, k in enumerate(keys):
        for r, path in inner[k]:
            full = path + upper[n]
            fold = leaf_of(r, r["text"].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) if tamper(r) else None)
            for left, right in full:
                fold = H(left, fold, right)
            proof = H(*(left + right for left, right in full))
            out.append((r["doc_id"], leaf_of(r), subs[k], root, proof, fold, fold == root))
    return sorted(out, key=repr)


def query(docs):
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(chosen, F.translate("text", queries.UPPER, queries.UPPER.lower())).otherwise(F.col("text"))
    fields = [merkle.field(c) for c in ("doc_id", "source", "lang", "n_chars")] + [merkle.field(text)]
    built = merkle.manifest(docs, carry={"tampered": merkle.digest(*fields)})
    folded = merkle.fold(F.col("tampered"), F.col("path"))
    return built.select("doc_id", "leaf", "subroot", "root", "proof_sha256", folded.alias("f"), (folded == F.col("root")).alias("v"))


def test_equals_plain_tree_on_documents(spark, documents):
    got = sorted(map(tuple, query(documents).collect()), key=repr)
    want = brute(documents.collect())
    assert got == want
    assert len({r[3] for r in got}) == 1 and 0 < sum(not r[6] for r in got) < len(got)


def test_odd_rows_and_small_arities(spark, odd, none):
    rows = odd.collect()
    assert sorted(map(tuple, query(odd).collect()), key=repr) == brute(rows)
    for arity in (2, 3):
        got = merkle.manifest(odd, arity=arity).select("doc_id", "leaf", "subroot", "root", "proof_sha256").collect()
        want = [r[:5] for r in brute(rows, arity)]
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert query(none).count() == 0


def test_single_row_is_its_own_root(spark):
    one = spark.createDataFrame([(1, "Text", "en", "s", 4)], "doc_id long, text string, lang string, source string, n_chars long")
    (r,) = query(one).collect()
    assert r["leaf"] == r["subroot"] == r["root"] and r["proof_sha256"] == H()

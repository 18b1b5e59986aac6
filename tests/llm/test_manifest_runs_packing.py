"""Merkle manifest, periodic runs and packing against plain Python and SQL."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from compare import compare, connect
from larder.llm import merkle, packing, runs
from larder.llm.encoding import located
from larder.llm.queries import BYTE_TOKENIZER, ORACLE, QUERIES

MIDDLE = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, tree string, words string, length int, n long"


def table(spark, rows):
    """Documents with columns beside their own whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "k", "t", "w", 1, 2) for r in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 11 manifest


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def up(tree, i):
    for level in tree[:-1]:
        a = i // 8 * 8
        yield level[a:i], level[i + 1 : a + 8]
        i //= 8


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_manifest(rows):
    trees = {}
    for doc_id, text, lang, source, n_chars in rows:
        head = "".join(map(field, (doc_id, source, lang, n_chars)))
        own = sha(head + field(text))
        tampered = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        claim = sha(head + field(re.sub("[A-Z]", lambda m: m[0].lower(), text))) if tampered else own
        trees.setdefault(lang, []).append(((doc_id is not None, doc_id or 0, own), doc_id, own, claim))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for n in names:
        trees[n].sort(key=lambda x: x[0])
    laid = [levels([x[2] for x in trees[n]]) for n in names]
    top = levels([x[-1][0] for x in laid]) if laid else None
    for k, n in enumerate(names):
        for i, (_, doc_id, own, claim) in enumerate(trees[n]):
            path = [*up(laid[k], i), *up(top, k)]
            for a, b in path:
                claim = sha("".join(a) + claim + "".join(b))
            root = top[-1][0]
            yield doc_id, own, laid[k][-1][0], root, sha("".join("".join(a + b) for a, b in path)), claim, claim == root


MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def manifest_rows(df):
    return sorted(([r[c] for c in MANIFEST] for r in df.collect()), key=repr)


def test_addresses_follow_the_recursion():
    assert merkle.address(0, np.array([0]), 5)[0] == 0
    for n in (1, 2, 3, 4, 5):
        taken = np.concatenate([merkle.address(d, np.arange(8**d), n) for d in range(n)])
        assert sorted(taken) == list(range(merkle.size(n)))
    # The top three levels come first, then bottom subtrees of nine nodes each.
    assert merkle.address(3, np.array([0, 1]), 5).tolist() == [73, 82] and merkle.address(4, np.array([0, 7, 8]), 5).tolist() == [74, 81, 83]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 600, 4096])
def test_siblings_come_from_their_addresses(n):
    leaves = [sha(str(i)) for i in range(n)]
    height = merkle.height_of(n)
    root, payload = merkle.lay_out(leaves, height)
    tree = levels(leaves)
    assert root == tree[-1][0] and len(tree) == height + 1
    for i in {0, n // 2, n - 1}:
        path = merkle.siblings(payload, n, height, i)
        assert [others for _, others in path] == ["".join(a + b) for a, b in up(tree, i)]
        assert merkle.fold(leaves[i], path) == root and merkle.fold(sha("x"), path) != root


def test_manifest_of_odd_rows(spark):
    rows = [
        (1, "Ab", "de", None, None), (1, "Ab", "de", None, None), (1, "other", "de", None, 5), (None, None, None, None, None), (None, "X", None, "s", 1),
        (5, "", "", "s", 0), (7, "É ABC 漢", "ü", "s", 7), (8, None, "z", "s", 7), (-3, "q" * 300_000, "de", "s", 1),
    ]
    rows += [(i, f"Text {i}", "en", "s", i) for i in range(100)] + [(i, "T", f"l{i:02}", "s", i) for i in range(70)]
    assert manifest_rows(merkle.report(table(spark, rows))) == sorted(map(list, plain_manifest(rows)), key=repr)
    assert merkle.report(table(spark, [])).count() == 0
    assert manifest_rows(merkle.report(table(spark, rows[:1]))) == sorted(map(list, plain_manifest(rows[:1])), key=repr)


def test_manifest_of_a_hot_language_over_many_blocks(spark):
    n = 10_000
    df = spark.range(n).selectExpr("id AS doc_id", "concat('Text ', id) AS text", "IF(id % 50 = 0, concat('l', id), 'en') AS lang", "'s' AS source", "id AS n_chars")
    want = sorted(map(list, plain_manifest([tuple(r) for r in df.collect()])), key=repr)
    assert manifest_rows(merkle.report(df)) == want


def test_manifest_equals_sql(spark):
    assert compare(QUERIES["op11_merkle_manifest"](spark, MIDDLE), connect(MIDDLE), ORACLE["op11_merkle_manifest"]) == []


# --- 12 runs


def plain_runs(doc_id, text, own):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if own and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i - start + q >= max(24, 3 * q):
                found.append((start, i - start + q, q))
            i += 1
    found = sorted((x for x in found if not any(q < x[2] and s <= x[0] and x[0] + x[1] <= s + k for s, k, q in found)), key=lambda x: (x[0], x[2]))
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    best = max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return n, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(lines), sha(kept)


RUNS = ("n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


@pytest.mark.parametrize("own", [False, True])
def test_runs(spark, own):
    rnd = random.Random(5)
    texts = [None, "", " \n\t", "a", "é 漢 " * 30, "one two three\n" * 500, "a " * 3000, "a b " * 12, "a " * 23, "a " * 24, "x" * 70_000 + " y"]
    for _ in range(300):
        parts, letters = [], rnd.choice([2, 3, 12])
        while sum(map(len, parts)) < rnd.choice([30, 200, 800, 3000]):
            unit = [rnd.choice("abcdefghijkl"[:letters]) for _ in range(rnd.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 64, 100, 257]))]
            parts.append([unit[i % len(unit)] for i in range(rnd.randint(0, 5 * len(unit)))])
        texts.append(" ".join(x for p in parts for x in p))
    for q in (1, 7, 16, 40, 300, 700):  # over several tiles
        texts.append(" ".join([f"z{i}" for i in range(rnd.randint(0, 2000))] + [f"w{i % q}" for i in range(rnd.randint(3 * q, 3 * q + 6000))] + [f"y{i}" for i in range(500)]))
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(None, "a b " * 30, None, None, None)] * 2
    found = runs.detect(table(spark, rows), own, keep_text=True).collect()
    got = {r.doc_id: r for r in found}
    assert len(found) == len(rows) and sum(r.doc_id is None for r in found) == 2
    for i, t in [*enumerate(texts), (None, "a b " * 30)]:
        assert tuple(got[i][c] for c in RUNS) == plain_runs(i, t, own), (i, (t or "")[:60])
        assert (got[i].collapsed is None) == (got[i].n_runs == 0)
    assert sum(r.n_runs > 0 for r in found) > 100
    assert runs.detect(table(spark, []), own).count() == 0


def test_z_function():
    rnd = random.Random(1)
    for _ in range(200):
        s = [rnd.randint(0, 1) for _ in range(rnd.randint(0, 40))]
        assert runs.z_function(s) == [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]


def test_runs_of_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect() if len(r.text) < 4000}
    for r in QUERIES["op12_periodic_runs"](spark, MIDDLE).collect():
        if r.doc_id in docs:
            assert tuple(r[c] for c in RUNS) == plain_runs(r.doc_id, docs[r.doc_id], True)


# --- 13 packing


def verified(rows, texts, length=packing.LENGTH):
    """Checks pieces against the tokenizers library; the number of sequences, and the least possible by tokens."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(located(BYTE_TOKENIZER))
    by_id, placed = {}, {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts.items():
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        pieces, at = sorted(by_id[doc_id], key=lambda r: r.piece), 0
        for k, r in enumerate(pieces):
            assert (r.piece, r.start) == (k, at) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            assert r.length == length or k == 0 and 0 < r.length < length
            at += r.length
            placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert at == len(ids) and len(pieces) == -(-len(ids) // length)
    for s in placed.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= length
    return len(placed), -(-sum(n for s in placed.values() for _, n in s) // length)


@pytest.mark.parametrize("group", [packing.GROUP_PIECES, 100])
def test_packing_of_documents(spark, group):
    df = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    used, least = verified(packing.pack(df, BYTE_TOKENIZER, 2, group_pieces=group).collect(), {r.doc_id: r.text for r in df.collect()})
    assert used <= (1.01 if group > 1000 else 1.06) * least


def test_sequences_hold_the_ids(spark):
    texts = [None, "", " \n", "a", "word " * 1023, "word " * 1024, "w" * 9000, "é 漢 \U0001f600", "a b", "a b"]
    df = table(spark, [(i, t, None, None, None) for i, t in enumerate(texts)] + [(None, "x y", None, None, None)] * 2)
    packed = packing.pack(df, BYTE_TOKENIZER, 2, keep_ids=True)
    rows = packed.collect()
    assert sum(r.doc_id is None for r in rows) == 2
    held = {r.sequence_id: (r.ids, r.doc_ids) for r in packing.sequences(packed).collect()}
    for r in rows:
        ids, docs = held[r.sequence_id]
        assert ids[4 * r.offset : 4 * (r.offset + r.length)] == r.ids and zlib.crc32(bytes(r.ids)) == r.ids_crc32 and r.doc_id in docs
    assert packing.report(table(spark, []), BYTE_TOKENIZER).count() == 0
    alone = table(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    verified(packing.report(alone, BYTE_TOKENIZER).collect(), dict(enumerate(texts)))


def test_each_piece_goes_where_the_squares_become_smallest():
    random_ = np.random.default_rng(2)
    sizes, length = random_.integers(1, 40, 500), 40
    sizes = sizes[sizes < length]
    bins = packing.sum_of_squares(sizes, length)
    where = {i: k for k, b in enumerate(bins) for i in b}
    gaps = {}

    def squares(state):
        counts = np.bincount(list(state.values()), minlength=length + 1)[1:length]
        return int((counts**2).sum())

    for i, size in enumerate(sizes.tolist()):
        options = [squares({**gaps, k: g - size}) for k, g in gaps.items() if g >= size] + [squares({**gaps, -1: length - size})]
        k = where[i]
        gaps[k] = gaps.get(k, length) - size
        assert squares(gaps) == min(options)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))


def test_pieces_that_do_not_go_together_stay_bounded():
    sizes = np.full(3200, 600)
    number, offset, handed = packing.pack_group(sizes, 1024, 200)
    assert handed.sum() == 200 and len(set(number[~handed])) == 3000 and not offset.any()
    number, _, handed = packing.pack_group(sizes, 1024, None)
    assert not handed.any() and len(set(number)) == 3200

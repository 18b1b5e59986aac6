"""The operators for training text against brute force, exact round trips, held-out labels and SQL."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import compare, connect
from larder.llm import decontaminate, language, licenses, main_text, mixing, near_duplicates, parity_join, perplexity, planes, secret_scan, severity
from larder.llm.encoding import Encoder, located
from larder.llm.queries import ORACLE, QUERIES, TOKENIZER
from larder.llm.shared import fresh

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, **more):
    rows = [(i, t, more.get("lang", "en"), more.get("source", "s"), len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def by_id(df, name="doc_id"):
    return {r[name]: r.asDict() for r in df.collect()}


ODD = [None, "", " \n\t ", "a", "é ü 漢字 \U0001f600", "x" * 70_000 + " y", "one two three\n" * 500]


def table(spark, name, folder=MIDDLE):
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- 1 secrets


def crc_token(prefix, body):
    number, digits = zlib.crc32(body.encode()), ""
    while number:
        number, r = divmod(number, 62)
        digits = secret_scan._BASE62[r] + digits
    return prefix + body + digits.rjust(6, "0")


BASE = [
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"AKIA[A-Z0-9]+", r"[0-9a-f]+",
]


def base_spans(text):
    least = [lambda m: len(m[2]) >= 6, lambda m: len(m[0]) >= 20, lambda m: len(m[0]) >= 24]
    found = [(m.start(), k, m.end()) for k in range(3) for m in re.finditer(BASE[k], text) if least[k](m)]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found)]


def test_secrets(spark):
    good = crc_token("ghp_", "aB3" * 10)
    texts = [
        *ODD, f"é {good} x", f"{good[:-1]}!", "PassWord='abc' Token:abcdef passwd = x secret=secret=abcdefg", "éé AKIA" + "Q" * 16 + " AKIAAKIA" + "0" * 14,
        "ſecret=abcdefgh Key", "0" * 23 + "g" + "a1" * 12, "api_key=\"AKIA" + "7" * 20, "token=" + "deadbeef" * 5,
    ]
    got = by_id(secret_scan.report(docs(spark, texts)))
    for i, t in enumerate(texts):
        want = base_spans(t or "")
        assert [s for s in got[i]["spans"].split(",") if s.split(":")[0] in secret_scan.BASE] == want, t[:60]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
    assert "forge:2:42" in got[len(ODD)]["spans"] and "forge" not in got[len(ODD) + 1]["spans"]


def test_checked_kinds_of_secrets(spark):
    import base64

    def part(raw):
        return base64.urlsafe_b64encode(raw).decode().rstrip("=")

    jwt = ".".join([part(b'{"alg":"HS256","typ":"JWT"}'), part(b'{"sub":"1234567890"}'), "s" * 20])
    der = bytes([0x30, 0x82, 0x01, 0x00]) + bytes(range(256))
    lines = base64.b64encode(der).decode()
    key = f"-----BEGIN RSA PRIVATE KEY-----\n{lines[:64]}\n{lines[64:]}\n-----END RSA PRIVATE KEY-----"
    good = crc_token("npm_", "Zz9" * 10)
    texts = [jwt, key, good, f"é {jwt} {key} {good}", jwt.replace(part(b'{"alg":"HS256","typ":"JWT"}'), part(b'{"nothing":"in here"}')), key.replace(lines[:8], "AAAAAAAA"), good[:-1] + "!", "eyJ" * 9 + " " + jwt]
    got = by_id(secret_scan.report(docs(spark, texts)))
    kinds = lambda i: [x.split(":")[0] for x in got[i]["spans"].split(",") if x.split(":")[0] not in (*secret_scan.BASE, "")]
    assert [kinds(i) for i in range(len(texts))] == [["jwt"], ["private_key"], ["registry"], ["jwt", "private_key", "registry"], [], [], [], ["jwt"]]
    assert f"jwt:2:{2 + len(jwt)}" in got[3]["spans"] and f"jwt:28:{28 + len(jwt)}" in got[7]["spans"]


def test_hostile_texts_take_linear_time():
    import time

    for text in ("eyJ" * 350_000, "eyJabcdefgh.eyJ" * 70_000, "-----BEGIN PRIVATE KEY-----a" * 40_000, "secret" + " " * 1_000_000, "ghp_" * 250_000):
        start = time.perf_counter()
        secret_scan.spans(text)
        assert time.perf_counter() - start < 5, text[:20]
    for page in ("<div><p>a, b" * 20_000, "<div>" * 20_000 + "x", "<b></i>" * 20_000, "<div><header>" * 10_000 + "y", "<li><div>" * 20_000 + "z", "<p>text, more" + "<span>" * 20_000 + "</span></div>" * 20_000):
        start = time.perf_counter()
        main_text.main_text(page)
        assert time.perf_counter() - start < 5, page[:20]
    assert main_text.main_text("<div>" * 5000 + "<p>deep, text</p>").strip() == "deep, text"


# --- 2 perplexity


def plain(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    three = list(zip(w, w[1:], w[2:]))
    many = {x for x in three if three.count(x) > 1} if len(three) < 3000 else None
    marked = {i + k for i, x in enumerate(three) if x in many for k in range(3)} if many is not None else range(len(w))
    n, r = len(w), len(marked)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, r, n < 50 or 100 * r > 50 * n


def test_plain_counts_and_verdict(spark):
    texts = ODD + [r.text for r in table(spark, "documents", SMALL).collect()]
    got = by_id(perplexity.judge(docs(spark, texts), least=10))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for i, t in enumerate(texts):
        assert tuple(got[i][n] for n in names) == plain(t), (t or "")[:50]
        assert not (got[i]["base_failed"] and got[i]["kept"])
    assert perplexity.judge(docs(spark, [])).count() == 0


def test_probabilities_sum_to_one(spark):
    model = perplexity.estimate(docs(spark, ["abab abba baab " * 20, "the cat sat on the mat " * 9]))
    for context in (b"\0ab", b"the", b"zzz"):
        packed = int.from_bytes(context, "big") << 8
        total = np.exp(perplexity.log_probability(model, np.arange(256, dtype=np.uint32) + np.uint32(packed))).sum()
        assert abs(total - 1) < 0.05, (context, total)


def test_no_n_gram_takes_the_place_of_another(spark):
    random = np.random.default_rng(5)
    varied = ["".join(map(chr, random.integers(0x4E00, 0x9F00, 1500))) for _ in range(300)]
    model = perplexity.estimate(docs(spark, varied))
    for context in (b"\0\0the", b"\0qzx", b"\0$$$"):
        packed = int.from_bytes(context[-3:], "big") << 8
        total = np.exp(perplexity.log_probability(model, np.arange(256, dtype=np.uint32) + np.uint32(packed))).sum()
        assert abs(total - 1) < 0.001, (context, total)


def test_shards_of_the_model_add_up(spark, monkeypatch):
    texts = ODD + [r.text for r in table(spark, "documents", SMALL).collect()] * 2
    want = by_id(perplexity.judge(docs(spark, texts)))
    monkeypatch.setattr(perplexity, "SHARD", 20_000)
    got = by_id(perplexity.judge(docs(spark, texts)))
    for i in want:
        assert got[i]["kept"] == want[i]["kept"] and got[i]["perplexity"] == pytest.approx(want[i]["perplexity"], abs=1e-5)


def test_a_small_language_beside_a_hot_one(spark):
    random = np.random.default_rng(6)

    def prose(words, n):
        return [" ".join(random.choice(words, 120)) for _ in range(n)]

    def word(letters):
        return "".join(random.choice(list(letters), random.integers(3, 9)))

    hot = prose([word("abcdefgh") for _ in range(300)], 900)
    few = prose([word("qrstuvwxyzäöüßéñ") for _ in range(2000)], 30)
    rows = [(i, t, "hot" if i < 900 else "few" if i < 925 else None, "s", len(t)) for i, t in enumerate(hot + few)]
    got = by_id(perplexity.judge(spark.createDataFrame(rows, SCHEMA)))
    assert not any(got[i]["base_failed"] for i in got)
    assert sum(got[i]["kept"] for i in range(900)) > 850
    assert sum(got[i]["kept"] for i in range(900, 925)) >= 20 and sum(got[i]["kept"] for i in range(925, 930)) >= 4


def test_bands_reject_gibberish_and_symbol_litter(spark):
    random = np.random.default_rng(7)
    clean = table(spark, "documents").join(table(spark, "labels").where("quality = 1"), "doc_id").orderBy("doc_id").collect()
    clean = [r for r in clean if len(r.text.split()) >= 120]
    texts = [r.text for r in clean]
    words = [t.split()[:120] for t in texts[:10]]
    noise = [" ".join("".join(map(chr, random.integers(97, 123, random.integers(3, 10)))) for _ in range(120)) for _ in range(10)]
    litter = [" ".join(w + random.choice(["$$$", "%%%", " |", "##"]) if random.random() < 0.4 else w for w in x) for x in words]
    langs = [r.lang for r in clean + clean[:10] * 2]
    rows = [(i, t, langs[i], "s", len(t)) for i, t in enumerate(texts + noise + litter)]
    got = by_id(perplexity.judge(spark.createDataFrame(rows, SCHEMA)))
    planted = range(len(texts), len(rows))
    assert not any(got[i]["base_failed"] for i in planted)
    assert not any(got[i]["kept"] for i in planted[:10])
    assert sum(got[i]["kept"] for i in planted[10:]) <= 2
    passed = [i for i in range(len(texts)) if not got[i]["base_failed"]]
    assert sum(got[i]["kept"] for i in passed) >= 0.85 * len(passed)


# --- 3 planes


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    ids = np.random.default_rng(1).integers(0, 2**32, 40_001, dtype=np.uint32)
    for n in (0, 1, planes.BLOCK_IDS, len(ids)):
        index, payload = planes.pack(ids[:n], kind)
        assert (planes.unpack(index, payload, kind) == ids[:n]).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_tokens_are_the_library_s(spark, kind):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(located(TOKENIZER))
    odd = [*ODD, "<|endoftext|>a <|startoftext|> b|>", "It's we'll ÉTÉ ß straße ſ ǅ Σας ΟΔΟΣ", "a,b. c!? d%%% 12 3x y z\r\nq", "é ́x ﬁ"]
    texts = odd + [r.text for r in table(spark, "documents", SMALL).collect()]
    path = fresh(spark, "planes")
    got = by_id(planes.report(docs(spark, texts), path, TOKENIZER, kind=kind))
    start = 0
    for i, t in enumerate(texts):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 1]
        assert got[i] == {"doc_id": i, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(np.array(ids, "<u4").tobytes())}, t
        start += len(ids)
    assert planes.report(docs(spark, []), fresh(spark, "planes"), TOKENIZER).count() == 0


SPACES = [
    "\n\n", " a  b ", "foo.\nBar  baz\t\tq", "x\u00a0  y z", "é à ç", "\u3000 a\u2003\u2003 b\u2003  c", "漢字 かな", "a\x1c b\x1f c", "don't I'll 1234 ab12",
    "<|endoftext|> x<|endoftext|>\n\nfoo", "a\u0301 \u0301b", "\u0085 a\u0085  b", "ſ ß İ", "\u1680 \u205f  x",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("budget", [0, 1 << 20])
def test_units_give_the_ids_of_whole_texts(name, budget):
    import pyarrow as pa
    from tokenizers import Tokenizer

    whole, encode = Tokenizer.from_file(located(name)), Encoder(located(name), budget)
    random = np.random.default_rng(3)
    signs = list("ab é.\n\t'1 漢") + ["\u00a0", "\u2003", " the", "<|endoftext|>"]
    made = ["".join(random.choice(signs, 40)) for _ in range(200)]
    texts = ODD + SPACES + made
    for _ in range(2):
        for row, ids, sizes in encode(pa.array(texts, pa.string()), 5):
            for i, (end, n) in enumerate(zip(np.cumsum(sizes), sizes)):
                assert ids[end - n : end].tolist() == whole.encode(texts[row + i] or "", add_special_tokens=False).ids + [5]


def test_units_of_one_hash_keep_their_own_ids(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr("larder.llm.arrays.mix", lambda x, seed=0: np.zeros(len(x), np.uint64))
    encode, plain = Encoder(located("byte_bpe_50k.json")), Encoder(located("byte_bpe_50k.json"), 0)
    texts = pa.array(["a b c a", "d a"])
    [(_, ids, sizes)] = list(encode(texts, 5))
    assert ids.tolist() == [x for t in texts.to_pylist() for x in [*plain.tokenizer.encode(t).ids, 5]] and sizes.tolist() == [5, 3]


# --- 4 severity


def test_severity_on_labels_left_out(spark):
    labels, large = table(spark, "labels", "/root/testdata/sf0.1"), table(spark, "documents", "/root/testdata/sf0.1")
    part = F.crc32(F.col("doc_id").cast("string")) % 4 == 0
    graded = severity.report(large, labels.where(~part)).withColumnRenamed("toxic", "said").join(labels.where(part), "doc_id").collect()
    hit, wrong = sum(r.said and r.toxic for r in graded), sum(r.said and not r.toxic for r in graded)
    assert hit >= 0.8 * sum(r.toxic for r in graded) and wrong <= 0.05 * len(graded)
    assert by_id(severity.report(docs(spark, ODD), labels))[0]["toxic"] is False
    assert all(not r.toxic for r in severity.report(docs(spark, ODD), labels.limit(0)).collect())


def test_samples_are_bounded_where_an_id_repeats(spark, monkeypatch):
    rows = [(0, f"same id and its text {i}", "en") for i in range(300)] + [(i, f"another text {i}", "de") for i in range(1, 20)]
    many = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, grade int")
    assert severity.labelled(many, labels, 20).count() == 20 and severity.labelled(many, labels, 1_000).count() == 319
    seen = []
    monkeypatch.setattr(language, "train", lambda x, y, names: seen.append((len(x), names)))
    for sample in (5, 1_000):
        language.fit(many, sample, each=2)
    assert seen[0][0] <= 10 and seen[1] == (319, ["de", "en"])


def test_thresholds_are_ordered():
    rng = np.random.default_rng(3)
    grade = rng.integers(0, 4, 400)
    _, cuts = severity.fit_ordinal(np.arange(400), grade.copy(), grade, np.ones(4), 4, steps=200)
    assert (np.diff(cuts) > 0).all()


# --- 5 parity join


def brute_classes(texts):
    low = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(licenses._LOWER)) for t in texts]
    sets = [{tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set() for w in low]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in range(len(sets))}


def test_classes_against_brute_force(spark):
    rng = np.random.default_rng(5)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 50_000, n)]
    texts = list(ODD)
    passage = word(60)
    for _ in range(70):  # a passage in many documents that are otherwise unlike, over half of some
        texts.append(" ".join(word(rng.integers(20, 90)) + passage + word(rng.integers(5, 60))))
    for changes in (1, 3, 6):  # groups of near copies, larger than a hot block, around and below the limit
        base = word(150)
        for _ in range(60):
            copy = list(base)
            for at in rng.integers(0, 150, changes):
                copy[at] = f"c{rng.integers(0, 10**9)}"
            texts.append(" ".join(copy))
    texts += texts[-20:] + [" ".join(word(n)) for n in range(1, 12)] + [texts[40].upper()] + ["b b b b b b b", "a b c d", "a  b c\td", "a b c"]
    got = by_id(parity_join.classes(docs(spark, texts)))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute_classes(texts)


def test_every_document_has_enough_blocks_at_its_band_s_level():
    texts = [" ".join(f"w{i}x{k}" for k in range(words)) for words in (7, 8, 18) for i in range(8_000)]
    data, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    sets = parity_join.Sets(data, offsets)
    bits, band = parity_join.levels(sets), sets.bands()
    level = np.zeros(sets.rows, int)
    for b in np.unique(band):
        level[band == b] = parity_join.coarsest(int(np.bitwise_and.reduce(bits[band == b])))
    blocks = sets.blocks(band, level)
    filled = np.bincount(np.unique(np.stack([sets.owner, blocks]), axis=1)[0], minlength=sets.rows)
    assert (filled >= parity_join.needed(sets.n)).all()


def test_one_of_each_class_stays(spark):
    texts = ["one two three four five six seven", "One two  three four five six seven", None, "", "other words altogether here now then"]
    both = docs(spark, texts).withColumn("extra", F.lit(1)).withColumn("node", F.lit("clash"))
    kept = near_duplicates.keep_one(both.unionByName(both.where("doc_id = 4")))
    assert kept.columns == both.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2, 3, 4]
    assert near_duplicates.keep_one(docs(spark, [])).count() == 0


# --- 6 licenses


def test_templates(spark):
    mit = next(t for label, t in licenses.TEMPLATES if label == "MIT").replace("<<var;words=12>>", "this software and docs")
    mit = re.sub("<<[^>]*>>", "", mit)
    texts = [
        *ODD, f"Copyright\n{mit.upper()}", mit.replace("free of charge", "free"), "Released under the MIT License.", "under the gnu  general\npublic-license, version 3",
        "This thing here is licensed under the Apache License, Version 2.0! cc by", "mit licenses apache",
    ]
    got = [by_id(licenses.report(docs(spark, texts)))[len(ODD) + k] for k in range(6)]
    assert [g["labels"] for g in got] == ["MIT", "", "MIT-notice,mit", "GPL-3.0,gpl", "Apache-2.0,apache,cc-by", ""]
    assert got[0]["score"] == 1 and 0 < got[1]["score"] < 1 and got[2]["first_word"] == 3 and got[5]["first_word"] is None
    with pytest.raises(ValueError):
        licenses.compile_template("x", "a <<beginOptional>> b")


def test_license_places_equal_plain_search(spark):
    phrases = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}
    texts = ODD + [r.text for r in table(spark, "documents", SMALL).collect()] + [
        "MIT License, mit-license! the Apache\nLicense apache license", "gnu general public gnu general public license", "cc by cc BY by cc", "É mit license", "mitlicense mit  license",
    ]
    got = by_id(licenses.report(docs(spark, texts)))
    for i, t in enumerate(texts):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        found = [(k, label) for label, p in phrases.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        places = [k for k, _ in found]
        want = (len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found})))
        assert tuple(got[i][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == want, (t or "")[:60]
    assert licenses.report(docs(spark, [])).count() == 0


# --- 7 decontamination


def test_windows_against_brute_force(spark):
    rng = np.random.default_rng(9)
    word = lambda n: [f"v{x}" for x in rng.integers(0, 12, n)]  # noqa: E731  few words, so that windows overlap and repeat
    items = [word(n) for n in (1, 4, 13, 14, 30, 40, 0, 6)] + [["q"] * 20]
    items[0] = ["lone"]
    texts = [" ".join(word(rng.integers(0, 80))) for _ in range(60)] + [" ".join(word(4) + items[5][k : k + 13 + k] + word(9)) for k in range(20)]
    texts += ["Q, q. " * 15, "a lone b", *ODD]
    bench = spark.createDataFrame([(i, " ".join(x).upper()) for i, x in enumerate(items)] + [(99, None)], "item_id long, text string")
    got = by_id(decontaminate.report(docs(spark, texts), bench))
    for i, t in enumerate(texts):
        w = licenses.words(t or "")
        hit, found = set(), set()
        for k, item in enumerate(items):
            n = min(13, len(item))
            for a in range(len(item) - n + 1 if n else 0):
                for b in range(len(w) - n + 1):
                    if w[b : b + n] == item[a : a + n]:
                        hit |= set(range(b, b + n))
                        found.add(str(k))
        want = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"], got[i]["items_sha256"]) == want, t
    parts = list(decontaminate.automata(bench, shard_words=30))
    assert len(parts) > 1
    cut = decontaminate.clean(docs(spark, ["x " * 300 + " ".join(items[4][:13]) + ". end", None]).withColumn("_more1", F.lit(1)), bench)
    rows = by_id(cut)
    assert rows[0]["text"] == "x " * 300 + ". end" and rows[0]["n_chars"] == 605 and rows[1]["text"] is None


# --- 8 language


def test_language_on_rows_held_out(spark):
    got = language.report(table(spark, "documents")).join(table(spark, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in got)
    few = by_id(language.report(docs(spark, ODD)))
    assert few[0]["lang_pred"] == few[1]["lang_pred"] == few[2]["lang_pred"] == "und"


# --- 9 mixing


def test_mix(spark):
    base = table(spark, "documents").select("doc_id", "text", F.when(F.col("source") != "src3", F.col("source")).alias("source"))
    got, again = mixing.report(base).collect(), mixing.report(base.repartition(5)).collect()
    assert sorted(got) == sorted(again)
    sizes = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in base.collect()}
    assert all(r["size"] == sizes[r.doc_id] and r.taken <= 2 * r["size"] for r in got)
    named = {r.doc_id: r.source for r in base.collect()}
    order = sorted({s for s in named.values() if s is not None}) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total = {s: sum(n for d, n in sizes.items() if named[d] == s) for s in order}
    want, full = {}, set()
    while True:
        rest = 1.5 * sum(total.values()) - sum(2 * total[s] for s in full)
        want = {s: 2 * total[s] if s in full else rest * weight[s] / sum(w for t, w in weight.items() if t not in full) for s in order}
        over = {s for s in order if want[s] > 2 * total[s]} - full
        if not over:
            break
        full |= over
    for s in order:
        rows = [r for r in got if named[r.doc_id] == s]
        assert abs(rows[0].target - want[s]) < 1e-6 * want[s] and rows[0].source_size == total[s]
        assert abs(sum(r.taken for r in rows) - want[s]) <= max(r["size"] for r in rows) / 2 + 1
    assert mixing.report(docs(spark, [])).count() == 0
    assert {r.taken for r in mixing.report(docs(spark, [None, ""])).collect()} == {0}


def test_rows_that_repeat_share_their_copies(spark):
    schema = "doc_id long, text string, source string, place long, copies long, n long, _key int"
    rows = [(7, "a b c d e", "s", i, 5, 6, 1) for i in range(4000)] + [(i, "x " * (i % 40 + 1), "t", i, 1, 1, 1) for i in range(100, 600)]
    df = spark.createDataFrame(rows, schema).repartition(5)
    report = mixing.report(df).collect()
    assert len(report) == 4500 and {r.taken for r in report if r.doc_id == 7} <= {0, 5, 10}
    took = sum(r.taken for r in report if r.doc_id == 7)
    target = next(r.target for r in report if r.doc_id == 7)
    assert abs(took - target) <= 3
    kept = mixing.mix(df)
    assert kept.columns == df.columns
    mixed = kept.collect()
    assert 5 * sum(r.doc_id == 7 for r in mixed) == took
    times = {}
    for r in mixed:
        times[r.place, r.doc_id] = times.get((r.place, r.doc_id), 0) + 1
    assert max(times.values()) <= 2 and sum(len(r.text.split()) for r in mixed if r.doc_id != 7) == sum(r.taken for r in report if r.doc_id != 7)



def test_pivot_keeps_the_mass_and_the_chances():
    rng = np.random.default_rng(2)
    sizes, share = np.array([3.0, 5, 7, 2, 2, 9]), np.array([0.3, 1.5, 0.8, 0.25, 0.1, 0.4])
    total = np.zeros(6)
    for _ in range(4000):
        copies, left = mixing.pivot(share, sizes, rng.random(6))
        assert abs((copies - share) @ sizes) < 1e-6
        total += copies
    assert np.abs(total / 4000 - share).max() < 0.05


# --- 10 main text


def test_main_text():
    page = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body class="home"><header><a href="/">Site</a></header>
    <nav><ul><li><a href="/a">Menu, one, two, three, four</a></li></ul></nav><div class="cookie-notice"><p>We use cookies, many, many.</p></div>
    <div id="main"><div class="post"><h1>Head&amp;line</h1><p>First, long   enough<br>to be, well, prose &eacute; and <b>more</b>.<p>Second &lt;one&gt;
    <!-- no --><ul><li>point a<li>point b</ul><blockquote>said</blockquote><form><input value=x>Send</form></div>
    <div class="comments"><p>Nice article, really, thank you, all of you, very much so, indeed.</p></div></div>
    <aside>aside, aside</aside><footer>(c) all, rights</footer>"""
    want = "Head&line\nFirst, long enough to be, well, prose é and more.\nSecond <one>\npoint a\npoint b\nsaid"
    assert main_text.main_text(page) == want
    assert main_text.main_text(page.replace('<div class="post">', "<article>").replace("</form></div>", "</form></article>")) == want
    assert main_text.main_text(None) == main_text.main_text("") == main_text.main_text("<script>x") == ""
    for n in range(0, len(page), 7):
        main_text.main_text(page[:n])


PROSE = "A long sentence of the article, with commas, words, and more words, so that it counts as prose of the page. " * 4


@pytest.mark.parametrize("wrap", ['class="content-sidebar-wrap"', 'class="container no-sidebar"', 'class="site has-header"', 'id="search-main"'])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_wrappers_with_names_of_boilerplate(wrap, inner):
    page = f"""<body><div {wrap}><{inner}><h1>Head</h1><p>{PROSE}</p><p class="advert">Buy this, now.</p><p>Second. {PROSE}</p></{inner}>
    <div class="sidebar"><p>Aside, aside, aside.</p></div></div><div class="cookie-notice">We use cookies.</div></body>"""
    assert main_text.main_text(page) == f"Head\n{PROSE.strip()}\nSecond. {PROSE.strip()}"


def test_comments_in_articles_of_their_own():
    comments = "<article class='comment'><p>Nice, really, thank you, all of you.</p></article>" * 3
    page = f"<main class='has-sidebar'><article><p>{PROSE}</p></article><div class='comments'>{comments}</div></main>"
    assert main_text.main_text(page) == PROSE.strip()


def test_blocks_beside_the_best_one():
    page = f"""<body><div><div><h2>Head</h2><p>{PROSE}</p><p>{PROSE}</p></div><ul><li>first<li>second<li>third</ul><table><tr><td>cell</td></tr></table>
    <figure><figcaption>caption</figcaption></figure><section><p>Short.</p></section><div><p>The end.</p></div>
    <ul><li><a href="/a">Link one</a><li><a href="/b">Link two</a></ul></div></body>"""
    want = ["Head", PROSE.strip(), PROSE.strip(), "first", "second", "third", "cell", "caption", "Short.", "The end."]
    assert main_text.main_text(page).split("\n") == want


def test_articles_of_the_pages(spark):
    import html

    got = by_id(main_text.report(table(spark, "pages")), "page_id")
    for r in table(spark, "pages").collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        assert got[r.page_id]["text"] == "\n".join(b for b in blocks if b)


# --- queries and pipeline


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_and_sql(spark, name):
    assert compare(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name]) == []


def test_pipeline(spark, tmp_path):
    extra = table(spark, "documents").withColumn("_times", F.lit(1)).withColumn("node", F.when(F.col("doc_id") >= 0, "x")).withColumn("_times", F.when(F.col("doc_id") >= 0, 1))
    odd = spark.createDataFrame([(None, "some words", None, None, None, 1, "y"), (10**6, None, "en", "src1", 0, 1, None), (10**6 + 1, "", None, None, 0, None, "z")], extra.schema)
    rows, kept = extra.unionByName(odd), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, rows, MIDDLE).write.parquet(path)
        rows = spark.read.parquet(path)
        kept[name] = [r.doc_id for r in rows.select("doc_id").collect()]
        assert name == "token_output" or rows.columns == extra.columns
    toxic = {r.doc_id for r in table(spark, "labels").where("toxic = 1").collect()}
    clean = {r.doc_id for r in table(spark, "labels").where("toxic = 0").collect()}
    assert len(toxic & set(kept["toxicity"])) <= 0.6 * len(toxic) and len(clean - set(kept["toxicity"])) <= 0.03 * len(clean)
    base = table(spark, "documents").where(F.col("doc_id").isin([i for i in kept["toxicity"] if i is not None]))
    least = {r.component_id for r in parity_join.classes(base).collect()}
    assert {i for i in kept["near_duplicates"] if i is not None and i < 10**6} == least
    tainted = {r.doc_id for r in decontaminate.report(base, table(spark, "benchmark")).where("contaminated").collect()}
    assert set(kept["decontamination"]) == set(kept["near_duplicates"]) - tainted
    assert set(kept["mixing"]) <= set(kept["decontamination"]) and sorted(map(str, kept["token_output"])) == sorted(map(str, kept["mixing"]))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs(spark, []), MIDDLE).count() == 0

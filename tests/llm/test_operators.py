"""Operators against plain versions, exact round trips and held-out accuracy."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_data import DATA
from pyspark.sql import functions as F

from gneiss.llm import ann, langid, packing, quality, queries, rules, sentencepiece_sa, simhash, token_counts, tokens, tokenstore, warc
from gneiss.llm.common import shared_dir


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_simhash_against_all_pairs(spark, docs, texts):
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    expected = plain_components(prints)
    found = simhash.near_duplicates(docs, tree_rows=8).collect()
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in found} == {(i, f"{prints[i]:016x}", expected[i]) for i in texts}


def test_simhash_chains_and_chunks():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = np.array([b ^ np.uint64(1 << int(i)) ^ np.uint64(1 << int(j)) for b in base for i, j in rng.integers(0, 64, (8, 2))], dtype=np.uint64)
    fp = np.unique(np.concatenate([base, near]))
    left, right = simhash.bk_links(fp, np.zeros(len(fp), np.int64), np.full(len(fp), 2))
    d = np.bitwise_count(fp[:, None] ^ fp[None])
    assert set(zip(left.tolist(), right.tolist(), strict=True)) == {(i, j) for i, j in zip(*np.nonzero(d <= 3), strict=True) if i != j}
    for parts in (4, 5, 6):
        masks = np.array([m % (1 << 64) for m in simhash.band_masks(parts)], dtype=np.uint64)
        i, j = np.nonzero(d <= 3)
        assert (((fp[i] ^ fp[j])[:, None] & masks[None]) == 0).any(axis=1).all()


def test_simhash_shards_over_the_limit(spark):
    rng = np.random.default_rng(9)
    base = int(rng.integers(0, 2**63))
    crowd = {base ^ (int(rng.integers(0, 1 << 14)) << 20) for _ in range(400)}  # agree on 50 bits: over the limit twice
    fps = np.array(sorted(crowd | {int(x) for x in rng.integers(0, 2**63, 100)}), dtype=np.uint64)
    expected = simhash.local_roots(len(fps), *np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None]) <= 3))
    own = spark.createDataFrame([(i, 0, int(x)) for i, x in enumerate(fps.view(np.int64))], "id long, copy long, fp long")
    found = simhash.classes(own, F.col("id"), tree_rows=32).join(own, "fp").collect()
    assert {(r["id"], r["first"]) for r in found} == set(enumerate(expected.tolist()))
    for mask in simhash.band_masks(6)[:3]:
        inner = [m % (1 << 64) for m in simhash.inner_masks(mask)]
        assert len(inner) == 20 and all(m & (mask % (1 << 64)) == mask % (1 << 64) for m in inner)
        a = rng.integers(0, 64, (200, 3))
        for bits in a:
            differ = sum(1 << int(b) for b in set(bits.tolist())) & ~mask
            assert any(differ & m == 0 for m in inner)


def test_simhash_odd_rows(spark, odd_docs, no_docs):
    found = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(odd_docs).collect()}
    assert {(1, 1), (2, 1), (3, 3), (4, 3), (5, 3)} <= found and simhash.near_duplicates(odd_docs).count() == odd_docs.count()
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 6, 7]


def test_keep_one_by_component(spark):
    near, other = "the quick brown fox jumps over the lazy dog " * 40, [f"{x} " + " ".join(f"{x}{i}" for i in range(60)) for x in "abcdef"]
    groups = {"near": [(None, near), (None, near), (2, near), (3, near)], "a": [(None, other[0])], "b": [(None, other[1]), (None, other[1])], "c": [(9, other[2])], "d": [(9, other[3]), (9, other[3])], "e": [(2, other[4])], "f": [(None, other[5]), (0, other[5])]}
    docs = spark.createDataFrame([(i, t, x) for x, rows in groups.items() for i, t in rows], "doc_id long, text string, group string")
    for _ in range(2):
        found = simhash.keep_one(docs.repartition(3)).collect()
        assert sorted((r["group"], r["doc_id"]) for r in found if r["doc_id"] is not None) == [("c", 9), ("d", 9), ("e", 2), ("f", 0), ("near", 2)]
        assert sorted(r["group"] for r in found if r["doc_id"] is None) == ["a", "b"]
    rows = spark.createDataFrame([(7, None), (7, ""), (None, "one two three four"), (7, "One two three four")], "doc_id long, text string")
    assert sorted(((r["text"] or "").lower(), r["doc_id"]) for r in simhash.keep_one(rows).collect()) == [("", 7), ("one two three four", 7)]


def plain_counts(text):
    w = WORD.findall(text or "")
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n, r = len(w), len(covered)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), r, n < 50 or 100 * r > 50 * n


def test_quality_rules_against_a_loop(spark, docs, texts, odd_docs):
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = rules.judge(docs).collect()
    assert {(r["doc_id"], *(r[c] for c in columns)) for r in found} == {(i, *plain_counts(t)) for i, t in texts.items()}
    assert all(not (r["kept"] and r["base_failed"]) for r in found)
    odd = Counter(tuple(r[c] for c in columns) for r in rules.judge(odd_docs).collect())
    assert odd == Counter(plain_counts(r["text"]) for r in odd_docs.collect())


def plain_verdicts(rows, per_language=12):
    """(doc_id, kept) of (doc_id, text, lang) rows, by plain loops over the definitions."""
    def classes(t):
        kinds = [re.sub(p, "", t) for p in (r"[^\w\x20\x09-\x0D]|_", r"[A-Z\u00c0-\u00d6\u00d8-\u00de]", r"\d")]
        n, plain, upper, digits = len(t), len(kinds[0]), len(t) - len(kinds[1]), len(t) - len(kinds[2])
        space, symbols = n - sum(map(len, WORD.findall(t))), len(re.findall(r"[#*$%&|<>]", t))
        return [plain - upper - digits - space, upper, digits, space, symbols, n - plain - symbols]

    def distance(p, q):
        half = lambda a, b: sum(x * np.log2(2 * x / (x + y)) for x, y in zip(a, b, strict=True) if x)
        return np.sqrt(max(0.0, (half(p, q) + half(q, p)) / 2))

    docs = [(i, t or "", x) for i, t, x in rows]
    languages = {x for _, t, x in rows if x is not None and t is not None}
    wanted = set()
    for x in languages:
        held = Counter(w for _, t, y in docs if y == x for w in set(WORD.findall(t)) if re.search(r"[^\W\d_]", w))
        wanted |= {w for w, _ in sorted(held.items(), key=lambda kv: (-kv[1], kv[0].encode()))[:per_language]}
    wanted = sorted(wanted)
    made = []
    for i, t, x in docs:
        words = WORD.findall(t)
        hits = [words.count(w) for w in wanted]
        made.append((i, x, plain_counts(t)[-1], len(t), len(words), classes(t), [*hits, len(words) - sum(hits)]))
    share = lambda v: [n / sum(v) for n in v] if sum(v) else [0.0] * len(v)

    def summed(rows):
        use = [r for r in rows if not r[2] and r[1] in languages]
        return [tuple(share([sum(v) for v in zip(*(r[k] for r in use if r[1] == x), strict=True)]) for k in (5, 6)) for x in sorted({r[1] for r in use})]

    first = summed(made)
    refs = summed([r for r in made if min(distance(share(r[5]), c) for c, _ in first) <= rules.TRIM_DISTANCE])
    out = []
    for i, _, failed, n, n_words, c, w in made:
        fits = [(n < 200 or distance(share(c), qc) <= rules.MAX_CLASS_DISTANCE + rules.CLASS_NOISE / np.sqrt(n)) and (n_words < 100 or distance(share(w), qw) <= rules.MAX_WORD_SHARE * distance([0.0] * (len(qw) - 1) + [1.0], qw)) for qc, qw in refs]
        out.append((i, not failed and (any(fits) or not refs)))
    return sorted(out)


def test_quality_rules_verdict(spark, docs):
    counts = rules.document_counts(docs, "doc_id", "text", "lang", ["the", "und"]).collect()
    assert all(sum(r["classes"]) == r["n_chars"] and min(r["classes"]) >= 0 for r in counts)
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.select("doc_id", "text", "lang").collect()]
    assert sorted((r["doc_id"], r["kept"]) for r in rules.judge(docs).collect()) == plain_verdicts(rows)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    by = {(r["quality"], r["base_failed"]): (r["kept"], r["n"]) for r in rules.judge(docs).join(labels, "doc_id").groupBy("quality", "base_failed").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.count(F.lit(1)).alias("n")).collect()}
    assert by[1, False][0] > 0.97 and by[0, False][0] < 0.5


def test_quality_rules_of_any_language(spark, no_docs):
    rng = np.random.default_rng(8)
    own = {x: [f"{x}{a}{b}" for a in "aeiou" for b in "klmn"] for x in ("q", "z")}
    rows = [(i, " ".join(rng.choice(own["qz"[i % 2]], 160)) + f" {i} end", "qz"[i % 2]) for i in range(40)]
    rows += [(100, " ".join(f"xx{j}y" for j in range(160)), None), (101, None, "q"), (102, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: r["kept"] for r in rules.judge(df).collect()}
    expected = dict(plain_verdicts(rows))
    assert found == expected and sum(found[i] for i in range(40)) > 35 and not found[100]
    assert rules.judge(no_docs).count() == 0 and not any(r["kept"] for r in rules.judge(no_docs.unionByName(df.where("doc_id > 100").withColumns({"source": F.lit("s"), "n_chars": F.lit(1)}))).collect())
    found = spark.createDataFrame([(["b", "a", "b", "c"],), ([],)], "w array<string>")
    assert [[tuple(x) for x in r["n"]] for r in rules.counted_words(found, "w", ["a", "b"], "n").collect()] == [[(0, 1), (1, 2)], []]


def test_js_distance(spark):
    p, q, r = np.array([0.5, 0.5, 0.0, 0.0, 0.0, 0.0]), np.array([0.25, 0.25, 0.5, 0.0, 0.0, 0.0]), np.full(6, 1 / 6)
    refs = rules.References([q.tolist(), r.tolist()], [q.tolist(), r.tolist()])

    def plain(q):
        m = (p + q) / 2
        kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m, strict=True) if x)
        return np.sqrt((kl(p) + kl(q)) / 2)

    sparse = F.array(*(F.struct(F.lit(i).alias("at"), F.lit(float(x)).alias("share")) for i, x in enumerate(p) if x))
    dense = F.array(*map(F.lit, p.tolist()))
    for found in spark.range(1).select(rules.class_distances(dense, refs), rules.word_distances(sparse, refs)).first():
        assert found == pytest.approx([plain(q), plain(r)])
    assert rules.wordless_distance([0.3, 0.7]) == pytest.approx(np.sqrt((0.3 + np.log2(1 / 0.85) + 0.7 * np.log2(0.7 / 0.85)) / 2))


def test_quality_classifier(spark, odd_docs, no_docs):
    big = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{big}/labels.parquet")
    found = quality.classify(spark.read.parquet(f"{big}/documents.parquet"), labels).join(labels, "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95 and all(0 <= r["score"] <= 1 for r in found)
    odd = quality.classify(odd_docs, labels).collect()
    assert len(odd) == odd_docs.count() and {r["held_out"] for r in odd if r["doc_id"] is None} == {None}
    assert quality.classify(no_docs, labels.limit(0)).count() == 0
    assert quality.keep_good(odd_docs, labels).columns == odd_docs.columns


def test_rule_columns_agree_with_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.random((400, len(quality.STATISTICS)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] <= 0.4)).astype(float)
    model = quality.fit(x, y)
    df = spark.createDataFrame(x.tolist(), ", ".join(f"_{s} double" for s in quality.STATISTICS))
    assert np.allclose([r[0] for r in df.select(model.score()).collect()], model.predict(x)) and ((model.predict(x) > 0.5) == y).mean() > 0.97


def test_sentencepiece_equals_the_library(spark, texts, odd_docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_sa.default_path())
    codec = sentencepiece_sa.codec(sentencepiece_sa.default_path())
    all_texts = [*texts.values(), "", " ", "  a  b ", "日本語 안녕 😀 a😀b", "▁x▁", "a\x00b", "ab" * 900, "  " * 40, *(r["text"] or "" for r in odd_docs.collect() if r["doc_id"] != 6)]
    ids = codec.encode(all_texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == model.encode(all_texts)
    assert [codec.decode(np.frombuffer(x, "<u4")) for x in ids] == [model.decode(x) for x in model.encode(all_texts)]
    found = sentencepiece_sa.encode_texts(odd_docs)
    assert {r["n_pieces"] for r in found.where("doc_id in (3, 4)").collect()} == {0} and found.count() == odd_docs.count()
    back = {r["doc_id"]: r["text"] for r in sentencepiece_sa.decode_ids(found).collect()}
    assert back[1] == odd_docs.where("doc_id = 1").first()["text"]


def test_token_counts_equal_word_piece(spark, texts, odd_docs):
    from tokenizers import Tokenizer, models

    begin, middle = token_counts.vocabulary(token_counts.default_path())
    vocab = {"[UNK]": 0}
    for p in [*begin, *("##" + m for m in middle)]:
        vocab.setdefault(p, len(vocab))
    model = Tokenizer(models.WordPiece(vocab=vocab, unk_token="[UNK]", max_input_chars_per_word=10**7)).model
    words = sorted({w for t in texts.values() for w in t.split() if not w.startswith("#")} | {"日本語", "กข", "a😀b", "naïve"})
    expected = [-1 if (t := model.tokenize(w))[0].value == "[UNK]" else len(t) for w in words]
    assert token_counts.automaton(token_counts.default_path()).counts(words).tolist() == expected
    odd = {r["doc_id"]: r for r in token_counts.count_tokens(odd_docs).collect()}
    assert odd[3]["n_words"] == odd[4]["n_tokens"] == 0 and odd[6]["n_words"] == 1 + 3 * 20_000


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_path())
    return lambda text: np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")


def test_encoder_equals_the_library(texts, library):
    odd = ["  a  b\n c", "\n \nx", "it's <|endoftext|> ok ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b\n", "<|endoftext", "", " ", "a\x1c b", "日本語 テキスト 　 x", "  a \x85 b", "él. Ünd, ß! x", "a\x00b c", "a" * 300]
    own = tokens.Encoder(tokens.default_path())
    all_texts = [*texts.values(), *odd]
    assert own.encode(all_texts) == [library(t)[:-1].tobytes() for t in all_texts]
    assert np.frombuffer(own.encode(["a <|endoftext|> b"])[0], "<u4").tolist() == [64, 220, 50256, 275]


def test_encoder_of_another_kind(texts, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer, models, pre_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    other = Tokenizer(models.BPE(vocab={"a": 0, "b": 1, "ab": 2}, merges=[("a", "b")]))
    other.pre_tokenizer = pre_tokenizers.Whitespace()
    other.save(str(tmp_path / "small.json"))
    for p in (path, str(tmp_path / "small.json")):
        t, own = Tokenizer.from_file(p), tokens.Encoder(p)
        assert not own.by_pieces
        some = [*list(texts.values())[:30], "", "Ab ab  b", "<|endoftext|> x"]
        assert own.encode(some) == [np.array(t.encode(x, add_special_tokens=False).ids, dtype="<u4").tobytes() for x in some]


def check_packing(rows, ids_of, capacity=1024):
    total, bins = Counter(), {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        total[r["doc_id"]] += r["length"]
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return total, bins


def test_packing(spark, docs, texts, odd_docs, no_docs, library):
    ids = {i: library(t) for i, t in texts.items()}
    rows = packing.pack_documents(docs).collect()
    total, bins = check_packing(rows, ids)
    assert total == {i: len(x) for i, x in ids.items()}
    for r in rows:
        own = ids[r["doc_id"]]
        assert zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(own)
    for i in ids:
        parts = sorted((r["start"], r["length"]) for r in rows if r["doc_id"] == i)
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False)) and parts[0][0] == 0
    assert sum(total.values()) / (1024 * len(bins)) > 0.97
    odd = packing.pack_documents(odd_docs, with_ids=True).collect()
    total, _ = check_packing(odd, None)
    assert total[3] == total[4] == 1 and total[2] == 2 * len(library(odd_docs.where("doc_id = 1").first()["text"]))
    assert packing.pack_documents(no_docs).count() == 0


def test_cuts():
    for n in range(1, 3000):
        c = packing.cuts(n)
        assert sum(c) == n and max(c) <= 1024 and min(c) > 0


def test_token_files(spark, docs, texts, odd_docs, no_docs, library):
    folder = f"{shared_dir(spark)}/token-test"
    manifest = tokenstore.write_tokens(docs, folder, file_ids=5000)
    assert manifest.count() > 4
    rows = {r["doc_id"]: r for r in tokenstore.read_tokens(manifest, folder).collect()}
    at = 0
    for i in sorted(texts):
        own = library(texts[i])
        assert (rows[i]["start"], rows[i]["n_tokens"], bytes(rows[i]["ids"])) == (at, len(own), own.tobytes())
        at += len(own)
    odd = tokenstore.read_tokens(tokenstore.write_tokens(odd_docs, f"{folder}-odd"), f"{folder}-odd").orderBy("start").collect()
    assert [r["doc_id"] for r in odd] == [None, 1, 2, 2, 3, 4, 5, 6, 7] and odd[4]["n_tokens"] == 1
    assert tokenstore.read_tokens(tokenstore.write_tokens(no_docs, f"{folder}-none"), f"{folder}-none").count() == 0


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, top in ((1, 1), (5, 5), (1000, 3), (3000, 900), (2000, 1)):
        ends = np.cumsum(rng.integers(0, top + 1, n))
        ef = tokenstore.EliasFano.encode(ends, int(ends[-1]), sample=64)
        assert (ef.ends() == ends).all() and [ef.select(i) for i in range(n)] == ends.tolist()
    docs = [np.arange(k, dtype="<u4").tobytes() for k in (3, 0, 70000, 1)]
    f = tokenstore.TokenFile(tokenstore.pack_file([None, 4, 5, 6], docs, 4))
    assert [f.document(i).tolist() for i in range(4)] == [list(range(k)) for k in (3, 0, 70000, 1)] and f.nulls == 1


def test_warc(spark, no_docs):
    long = "<p>page</p>" * 20
    rows = [(3, "http://a/\nb", long), (1, None, long), (2, "http://c", "short"), (5, "http://d", "short"), (4, "http://e", None), (None, "http://f", long), (6, "http://g", "other " * 50), (1, None, long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    for compression in ("gzip", "none"):
        folder = f"{shared_dir(spark)}/warc-{compression}"
        warc.archive_pages(pages, folder, compression)
        found = sorted(((r["page_id"] or 0), r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.archived_pages(spark, folder).collect())
        assert found == [(0, "revisit", 1, 220), (1, "response", None, 220), (1, "response", None, 220), (2, "response", None, 5), (3, "revisit", 1, 220), (4, "response", None, 0), (5, "response", None, 5), (6, "response", None, 300)]
        df = warc.read_warc(spark, folder, payload=False).where("warc_type = 'revisit' and page_id in (3, 6)")
        assert [(r["page_id"], r["payload"]) for r in df.collect()] == [(3, None)] and "warcinfo" in {r[0] for r in warc.read_warc(spark, folder, False).select("warc_type").collect()}
        text = warc.read_warc(spark, folder).where("page_id = 6").first()
        assert bytes(text["payload"]).decode() == "other " * 50
    assert warc.plan_records(pages.limit(0)).count() == 0
    folder = f"{shared_dir(spark)}/warc-empty"
    warc.archive_pages(pages.limit(0), folder)
    assert warc.archived_pages(spark, folder).count() == 0


def test_warc_of_other_writers_and_damage(spark, tmp_path):
    good = [warc.page_record("response", i, f"http://{i}", b"y" * 120, "d", 120, None) for i in range(4)]
    lower = good[1].replace(b"WARC-Type", b"warc-type").replace(b"Content-Length: ", b"content-length:", 1).replace(b"X-Page-ID: 1", b"x-page-id: one")
    (tmp_path / "a.warc").write_bytes(good[0] + lower + b"noise\r\n" + good[2])
    (tmp_path / "b.warc").write_bytes(good[3].replace(b"Content-Length: ", b"Content-Length: x", 1) + good[2][:-60])
    (tmp_path / "c.warc.gz").write_bytes(__import__("gzip").compress(good[1])[:-20])
    warc.register(spark)
    with pytest.raises(Exception, match="WARC|EOF|end-of-stream"):
        warc.read_warc(spark, f"file://{tmp_path}").collect()
    found = spark.read.format("warc").option("mode", "DROPMALFORMED").load(f"file://{tmp_path}").collect()
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "d.warc").write_bytes(good[0] + good[2][:-60])
    with pytest.raises(Exception, match="ends after"):  # seen without reading the block
        spark.read.format("warc").option("payload", "false").load(f"file://{tmp_path}/d").collect()
    assert sorted((r["page_id"] if r["page_id"] is not None else -1, r["target_uri"]) for r in found if len(r["payload"]) == 120) == [(-1, "http://1"), (0, "http://0"), (2, "http://2")]


def test_warc_skips_unwanted_blocks(tmp_path):
    import io

    data = b"".join(warc.page_record("response", i, None, b"x" * 50, "d", 50, None) for i in range(3))

    class Source(io.BytesIO):
        read_bytes = 0

        def read(self, n=-1):
            out = super().read(n)
            Source.read_bytes += len(out)
            return out

    found = list(warc.records(Source(data), lambda h: h["X-Page-ID"] == "1", True, size=len(data)))
    assert [p for _, p in found] == [b"x" * 50] and Source.read_bytes < 200


def test_language_id(spark, docs, odd_docs, no_docs):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.detect(big).join(big.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97 and all(0 <= r["score"] <= 1 for r in found)
    odd = langid.detect(odd_docs).collect()
    assert len(odd) == odd_docs.count() and {r["lang_pred"] for r in odd if r["doc_id"] in (3, 4, 5)} == {"und"}
    assert langid.detect(no_docs).count() == 0 and langid.keep_known(docs).columns == docs.columns


def test_language_sample_long_documents_and_rare_languages(spark, monkeypatch):
    words = {"en": "the of and that was with for this have from ", "fr": "le la les des dans une que est avec pour ", "xx": "zug zog zak zilk zam zorn zuv zek zib zol "}
    rows = [(i, words["en"] * 5, "en") for i in range(300)] + [(i, words["fr"] * 4000, "fr") for i in range(300, 330)]
    rows += [(i, words["xx"] * (40_000 if i == 401 else 3), "xx") for i in range(400, 404)] + [(7, words["fr"] + "fin", "fr")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    own = langid.fit
    monkeypatch.setattr(langid, "fit", lambda texts, langs: seen.append((texts, langs)) or own(texts, langs))
    found = langid.detect(docs).join(docs.select("doc_id", "lang").distinct(), "doc_id").where("doc_id <> 7")
    assert all(r["lang_pred"] == r["lang"] for r in found.collect())
    sizes = {x: [len(t) for t, y in zip(*seen[0], strict=True) if x == y] for x in words}
    assert all(sizes.values()) and len(sizes["fr"]) == 400 and sum(map(sum, sizes.values())) <= langid.SAMPLE_CHARS
    same = spark.createDataFrame([(9, words[x] * 3, x) for x in ("en", "fr") for _ in range(900)], "doc_id long, text string, lang string")
    assert zlib.crc32(b"9") % 3 != 1 and {(r["lang_pred"], r["n"]) for r in langid.detect(same).groupBy("lang_pred").agg(F.count(F.lit(1)).alias("n")).collect()} == {("en", 900), ("fr", 900)}
    assert Counter(seen[1][1]) == {"en": 600, "fr": 600}


def test_forward_backward_against_enumeration():
    from itertools import product

    rng = np.random.default_rng(2)
    e, t, s = rng.normal(size=(7, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    first = np.array([1, 0, 0, 0, 1, 0, 0], bool)
    p = np.zeros_like(e)
    for a, b in ((0, 4), (4, 7)):
        weights = {}
        for path in product(range(3), repeat=b - a):
            z = s[path[0]] + sum(e[a + i, y] for i, y in enumerate(path)) + sum(t[x, y] for x, y in zip(path, path[1:], strict=False))
            weights[path] = np.exp(z)
        for path, w in weights.items():
            for i, y in enumerate(path):
                p[a + i, y] += w / sum(weights.values())
    for name, small in (("_CHUNK", 3), ("_CHUNKED", 2)):  # in chunks, and a sequence a lane
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(langid, name, small)
            assert np.allclose(langid.forward_backward(e, first, t, s), p)


def test_crf_gradient_against_differences():
    def log_likelihood(data, w, t, s):
        total = 0.0
        e = np.array([[w[data.flat[data.owner == kind], c].sum() for c in range(data.k)] for kind in range(data.n_kinds)])[data.rows]
        for i in range(len(e)):
            y = data.gold[i]
            total += e[i, y] + (s[y] if data.first[i] else t[data.gold[i - 1], y])
        for a, b in zip(np.flatnonzero(data.first), [*np.flatnonzero(data.first)[1:], len(e)], strict=True):
            v = s + e[a]
            for i in range(a + 1, b):
                v = e[i] + np.log(np.exp(v[:, None] + t).sum(axis=0))
            total -= np.log(np.exp(v).sum())
        return total

    rng = np.random.default_rng(6)
    docs = [(x.split(), y) for x, y in zip(["aa bb aa cc", "bb dd", "ee aa", "cc cc dd bb", "aa"], [0, 1, 2, 0, 1], strict=True)]
    data = langid.Chains(docs, 3, 2)
    assert data.first.sum() == 3 and data.moved.sum() == (~data.first).sum()
    values = [rng.normal(size=(1 << langid.FEATURE_BITS, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)]
    found = data.gradient(*values)
    used = np.unique(data.flat)[:5]
    for which, places in ((0, [(int(u), c) for u in used for c in (0, 2)]), (1, [(i, j) for i in range(3) for j in range(3)]), (2, [(0,), (1,), (2,)])):
        for at in places:
            two = []
            for h in (1e-5, -1e-5):
                moved = [v.copy() for v in values]
                moved[which][at] += h
                two.append(log_likelihood(data, *moved))
            assert found[which][at] == pytest.approx((two[0] - two[1]) / 2e-5, abs=1e-5)


def test_held_out_mixed_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    off = model.transitions - np.diag(np.full(len(model.labels), np.inf))
    assert (np.diag(model.transitions) > off.max(axis=1)).all()
    held = [r for r in docs.select("doc_id", "text", "lang").orderBy("doc_id").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 and r["lang"] and len(langid.words_of(r["text"] or "")) >= 80]
    right = []
    for a, b in zip(held, held[1:], strict=False):
        if a["lang"] != b["lang"]:
            parts = [langid.words_of(x["text"])[20:50] for x in (a, b)]
            right += [y == x["lang"] for (_, y, _), x in zip(langid.label_words(model, " ".join(parts[0] + parts[1])), [a] * 30 + [b] * 30, strict=True)]
    assert len(right) > 1000 and np.mean(right) > 0.95


def test_code_switched_words():
    en, fr = "the of and that was with for this have from", "le la les des dans une que est avec pour"
    model = langid.fit([en] * 30 + [fr] * 30, ["en"] * 30 + ["fr"] * 30)
    labels = [y for _, y, _ in langid.label_words(model, f"{en} {fr}")]
    assert labels == ["en"] * 10 + ["fr"] * 10


def test_long_runs_are_judged_whole():
    en, fr = "theofandthatwaswithforthishavefrom", "lelalesdesdansunequeestavecpour"
    model = langid.fit(["the of and that was with for this have from " + en] * 30 + ["le la les des dans une que est avec pour " + fr] * 30, ["en"] * 30 + ["fr"] * 30)
    assert langid.predict_texts(model, [en * 2 + fr * 50, fr * 2 + en * 50, en * 30_000])[0] == ["fr", "en", "en"]
    fixed, trigrams, sizes = langid.features(["a" * 50 + "xyz", "b" + "xyz"])
    assert sizes.tolist() == [53, 4] and len(trigrams) == 57 and (fixed[0, 4:] == fixed[1, 4:]).all()
    assert not model.cache


def test_ann_recall_and_ties(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(900, 16)).astype(np.float32)
    v[200:500] = v[200]
    rows = [(int(i), v[i].tolist()) for i in range(900)] + [(1000, [0.0] * 16), (1001, None), (1002, [float("nan")] * 16), (None, v[1].tolist()), (1100, v[200].tolist()), (0, v[0].tolist()), (1200, [1.0, 2.0])]
    found = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)), shard_rows=250).collect()
    ids = np.array([*range(900), 1100])
    all_v = np.concatenate([v, v[200:201]]).astype(np.float64)
    hits = total = 0
    for q in (0, 100, 200, 300, 800, 1100):
        d = np.sqrt(((all_v - all_v[list(ids).index(q)]) ** 2).sum(axis=1))
        d[list(ids).index(q)] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [r for r, _, _ in own] == list(range(1, 11))
        hits, total = hits + len({i for _, i, _ in own} & set(best.tolist())), total + 10
        if q in (200, 300, 1100):
            assert [i for _, i, _ in own] == best.tolist()
    assert hits / total >= 0.9 and {r["query_id"] for r in found} == {0, 100, 200, 300, 400, 500, 600, 700, 800, 1100}
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def plain_recall(rows, vectors, k=10):
    """Share of the k nearest by brute force that were found; rows are (query id, id), ids are row numbers."""
    found = {}
    for q, i in rows:
        found.setdefault(q, set()).add(i)
    hits = 0
    for q, own in found.items():
        d = ((vectors - vectors[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += len(own & set(np.argsort(d, kind="stable")[:k].tolist()))
    return hits / (k * len(found))


def test_ann_recall_on_the_shared_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = table.select("vec_id", "embedding").orderBy("vec_id").collect()
    number = {r["vec_id"]: n for n, r in enumerate(rows)}
    v = np.array([r["embedding"] for r in rows], dtype=np.float64)
    found = ann.nearest(table).collect()
    assert len(found) == 10 * sum(i % 100 == 0 for i in number)
    assert plain_recall([(number[r["query_id"]], number[r["vec_id"]]) for r in found], v) >= 0.95


def test_graph_reads_a_part_of_its_shard():
    rng = np.random.default_rng(4)
    v = np.concatenate([rng.normal(size=(6_000, 12)), rng.normal(size=(200, 12)) * 30])
    graph = ann.Graph.build(v)
    assert (graph.edges >= 0).sum(axis=1).min() > 0 and graph.edges.max() < len(v) and not (graph.edges == np.arange(len(v))[:, None]).any()
    found, dist = graph.search(graph.scaled(v[:100]), 32)
    assert plain_recall([(q, int(i)) for q, row in enumerate(found) for i in [x for x in row if x != q][:10]], v) > 0.9
    assert graph.visited < 0.12 * len(v) * 100 and (np.diff(dist, axis=1) >= 0).all()


def test_ann_extreme_components(spark):
    rows = [(i, [float(i % 7 + 1) * 10.0**e, float(i % 11) * 10.0**e]) for e, first in ((300, 0), (-300, 300), (0, 600)) for i in range(first, first + 77)]
    found = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shard_rows=100)
    assert {(r["query_id"], r["n"]) for r in found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).collect()} == {(0, 10), (300, 10), (600, 10)}


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, now, DATA)
        assert found.columns == docs.columns
        assert found.join(now.select("doc_id"), "doc_id", "left_anti").count() == 0
        now = spark.createDataFrame(found.collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, now, DATA)
    keys = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, last.select(keys).collect())) == sorted(map(tuple, corpus_pipeline.run(spark, DATA).select(keys).collect()))
    assert {r["doc_id"] for r in last.collect()} == {r["doc_id"] for r in now.collect()}


def test_every_query_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))

"""Every operator on odd rows, empty tables and rows without ids, against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tidegrid.llm import kernels as K
from tidegrid.llm import op1_line_frequency as op1
from tidegrid.llm import op2_byte_cnn as op2
from tidegrid.llm import op3_training_order as op3
from tidegrid.llm import op4_importance as op4
from tidegrid.llm import op5_hyperminhash as op5
from tidegrid.llm import op6_bpe as op6
from tidegrid.llm import op7_mixing as op7
from tidegrid.llm import op8_suffix_dedup as op8
from tidegrid.llm import op9_media as op9
from tidegrid.llm import op10_rendezvous as op10
from tidegrid.llm.bloom import build
from tidegrid.llm.components import components
from tidegrid.llm.deep_shallow import deep_shallow_sort

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def multiset(rows):
    return Counter(tuple(r) for r in rows)


# 1 -----------------------------------------------------------------------------------


def test_line_quality_base(odd, odd_rows):
    got = op1.line_quality(odd).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert multiset(got) == multiset((r[0], *brute.base_counts(r[1])) for r in odd_rows)


def test_line_quality_verdict(spark):
    rng = random.Random(1)
    common = ["Shared line number %d of all" % k for k in range(3)]
    rows = []
    for i in range(90):
        own = [" ".join("w%d" % rng.randrange(5000) for _ in range(30)) for _ in range(2)]
        lines = own + (common * 4 if i % 3 == 0 else common[:1])
        rows.append((i, "\n".join(lines).upper() if i % 2 else "\n".join(lines), "h%d" % (i % 2)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    seen = defaultdict(set)
    for i, t, h in rows:
        for line in brute.normal_lines(t):
            seen[h, line].add(i)
    for r in op1.line_quality(docs, limit=10, least_kept=0.75).collect():
        _, text, host = rows[r.doc_id]
        lost = sum(n for line, n in brute.normal_lines(text).items() if len(seen[host, line]) > 10)
        n, _, _, _, rep = brute.base_counts(text)
        failed = n < 50 or 100 * rep > 50 * n
        assert (r.removed_words, r.base_failed) == (lost, failed)
        assert r.kept == (not failed and n - lost >= 0.75 * n)


def test_line_quality_edges(empty, no_ids):
    assert op1.line_quality(empty).count() == 0
    assert op1.line_quality(no_ids).where("not kept and base_failed").count() == 3


# 2 -----------------------------------------------------------------------------------


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in op2.language_query(docs).collect()}
    want = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i in got if got[i].held_out]
    assert held and all(zlib.crc32(str(i).encode()) % 4 == 2 for i in held)
    assert sum(got[i].lang_pred == want[i] for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_edges(odd, empty, no_ids):
    rows = {r.doc_id: r for r in op2.language_query(odd).collect()}
    assert rows[200].lang_pred == rows[201].lang_pred == rows[208].lang_pred == rows[209].lang_pred == "und"
    assert op2.language_query(empty).count() == 0
    assert [r.lang_pred for r in op2.language_query(no_ids).collect()] == ["und"] * 3  # nothing is labelled


# 3 -----------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_feistel_is_a_permutation(n):
    assert sorted(op3.feistel(np.arange(n), n, 9)) == list(range(n))


def test_training_order_reads_back(odd, odd_rows, tmp_path, empty):
    """Every column against a plain version, and every slot read back."""
    out = f"file://{tmp_path}/shards"
    enc = op6.encoder(RANKS, public_tokenizers.PATTERN)
    rows = op3.training_order(odd, out, RANKS, public_tokenizers.PATTERN, length=64, per_shard=100).collect()
    want = Counter()
    for r in odd_rows:
        ids = enc.encode_ordinary(r[1] or "")
        for k in range(0, len(ids), 64):
            want[r[0], k // 64, tuple(ids[k : k + 64])] += 1
    assert op3.manifest(out) == {"sequences": len(rows), "length": 64, "per_shard": 100, "shards": -(-len(rows) // 100), "key": 3, "id_bytes": 2}
    assert sorted(p.name for p in (tmp_path / "shards").iterdir() if not p.name.startswith(".")) == ["manifest.json"] + [f"shard-{k:08d}.bin" for k in range(-(-len(rows) // 100))]
    by = {r.slot: r for r in rows}
    assert sorted(by) == list(range(len(rows))) == sorted(op3.feistel(np.arange(len(rows)), len(rows), 3))
    read = list(op3.read_slots(out, 0, len(rows)))
    assert Counter((by[s].doc_id, by[s].seq, tuple(ids.tolist())) for s, ids in enumerate(read)) == want
    for s, ids in enumerate(read):
        r = by[s]
        record = len(ids).to_bytes(2, "little") + ids.astype("<u2").tobytes() + bytes(128 - 2 * len(ids))
        assert (r.shard, r.byte_offset, r.n_tokens, r.record_crc32) == (s // 100, s % 100 * 130, len(ids), zlib.crc32(record))
        assert (tmp_path / "shards" / f"shard-{r.shard:08d}.bin").read_bytes()[r.byte_offset :][:130] == record
    resumed = list(op3.read_slots(out, 150, 260))
    assert len(resumed) == 110 and all((a == b).all() for a, b in zip(resumed, read[150:]))
    none = op3.training_order(empty, f"file://{tmp_path}/none", RANKS, public_tokenizers.PATTERN)
    assert none.count() == 0 and op3.manifest(f"file://{tmp_path}/none")["sequences"] == 0
    with pytest.raises(FileNotFoundError):
        op3.manifest(f"file://{tmp_path}")


def test_shards_are_complete_before_anything_is_read(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i} " * 300) for i in range(60)], "doc_id long, text string")
    out = f"file://{tmp_path}/set"
    op3.training_order(docs, out, RANKS, public_tokenizers.PATTERN, length=32, per_shard=50).limit(1).collect()
    assert len(list((tmp_path / "set").glob("shard-*.bin"))) == op3.manifest(out)["shards"] > 10 and not list((tmp_path / "set").glob(".*.part"))


def test_a_placed_shard_stays(tmp_path):
    from pyarrow import fs

    local = fs.LocalFileSystem()
    for name in ("a.part", "b.part"):
        (tmp_path / name).write_bytes(name.encode())
        op3._place(local, str(tmp_path / name), str(tmp_path / "shard"))
    assert [(p.name, p.read_bytes()) for p in tmp_path.iterdir()] == [("shard", b"a.part")]


# 4 -----------------------------------------------------------------------------------


def test_importance_prefers_the_target(spark):
    rng = random.Random(3)
    good = ["".join(rng.choice("abc ") for _ in range(400)) for _ in range(100)]
    bad = ["".join(rng.choice("$%& ") for _ in range(400)) for _ in range(25)]
    docs = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i in range(0, 125, 2)], "doc_id long, quality int, toxic int")
    got = op4.importance_scores(docs, labels, keep_share=0.8).collect()
    assert {r.doc_id for r in got if r.kept} == set(range(100))
    assert {r.doc_id for r in op4.importance_select(docs, labels, keep_share=0.8).collect()} == set(range(100))


def test_importance_counts_against_plain(odd_rows):
    import pyarrow as pa

    for text in [r[1] for r in odd_rows[:20]] + [None, "", "abc", "abcd"]:
        for _, _, raw, offs in K.chunks(pa.array([text], pa.string())):
            bucket, _ = op4.ngrams(raw, offs)
        b = (text or "").encode()
        w = [x.lower() for x in brute.words(text)]
        assert len(bucket) == max(0, len(b) - 3) + sum(x == y for x, y in zip(w, w[1:]))


def test_kth_largest(spark):
    rng = random.Random(8)
    values = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(500)] + [5] * 40
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for k in (1, 7, 250, 400, 540):
        assert op4.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]


def test_importance_edges(spark, odd, empty, no_ids):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = op4.importance_scores(odd, labels).collect()
    assert all(not r.kept for r in rows if r.doc_id in (200, 201))
    assert op4.importance_scores(empty, labels).count() == 0
    assert op4.importance_scores(no_ids, labels).where("kept").count() == 2
    assert op4.importance_select(odd, labels).columns == odd.columns


# 5 -----------------------------------------------------------------------------------


def test_near_duplicates_against_plain(odd, odd_rows):
    got = op5.near_duplicates(odd).select("doc_id", "n_shingles", "component_id", "kept").collect()
    want = brute.near_components([(r[0], r[1]) for r in odd_rows])
    assert multiset(got) == multiset((r[0], n, c, r[0] == c) for r, (n, c) in zip(odd_rows, want, strict=True))


def test_near_duplicate_chains_in_one_bucket(spark):
    rng = random.Random(11)
    base = ["w%d" % rng.randrange(10_000) for _ in range(120)]
    rows = []
    for i in range(220):  # neighbours are close, ends are far
        base[rng.randrange(120)] = "x%d" % i
        rows.append((1000 - i, " ".join(base)))
    got = op5.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {r[0]: c for r, (_, c) in zip(rows, brute.near_components(rows), strict=True)}
    assert {r.doc_id: r.component_id for r in got} == want


def test_near_duplicate_edges(odd, empty, no_ids):
    assert op5.near_duplicates(empty).count() == 0
    assert op5.near_duplicates(no_ids).where("kept").count() == 2
    kept = op5.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in op5.near_duplicates(odd).where("kept").collect()}


def test_near_duplicates_at_another_threshold(spark):
    assert op5.bands_for(85) == op5.BANDS
    for percent in (70, 80, 85, 95):
        assert (1 - (percent / 100) ** op5.ROWS) ** op5.bands_for(percent) <= op5.MISS
    rows = []
    for k in range(40):  # the last 11 of 104 words differ: 89 of 111 shingles are common
        base = [f"w{k}x{i}" for i in range(104)]
        rows += [(10 * k, " ".join(base)), (10 * k + 1, " ".join(base[:93] + [f"v{k}x{i}" for i in range(11)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent, left in ((80, 40), (85, 80)):
        want = Counter(i for (i, _), (_, c) in zip(rows, brute.near_components(rows, percent), strict=True) if i == c)
        got = Counter(r.doc_id for r in op5.without_near_duplicates(docs, percent=percent).collect())
        assert got == want and len(got) == left


def test_one_row_of_each_component_stays(spark):
    long, other = " ".join(f"a{i}" for i in range(200)), " ".join(f"b{i}" for i in range(200))
    rows = [
        (1, long, "repeated"), (1, long, "repeated"), (1, long, "repeated"),
        (2, other, "first"), (3, other + " more", "near"), (3, "quite another text of its own", "kept under a reused id"),
        (None, "the same words without any id", "n"), (None, "the same words without any id", "n"), (None, long + " more", "near to 1"),
        (4, "", "empty"), (4, "", "empty"), (None, None, "null"),
    ]
    got = op5.without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, note string").repartition(3))
    assert multiset(got.collect()) == multiset([rows[0], rows[3], rows[5], rows[6], *rows[9:]])


def test_register_estimates():
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(0, 1 << 63, 2000, dtype=np.uint64))
    b = np.concatenate([a[:1500], rng.integers(0, 1 << 63, 500, dtype=np.uint64)])
    regs = op5.registers(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    e = op5.estimate(regs[:1], regs[1:], np.array([2000.0]), np.array([2000.0]))[0]
    assert abs(e - 1500 / 2500) < 5 * (0.24 / op5.REGISTERS) ** 0.5
    x = np.array([1, 1 << 63, 0, (1 << 40) + 12345], np.uint64)
    assert list(op5.leading_zeros(x)) == [63, 0, 63, 23]


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(60)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert got[start] == min(seen)
    assert set(got) == set(near)


# 6 -----------------------------------------------------------------------------------


def test_bpe_against_tiktoken(odd, odd_rows):
    enc = op6.encoder(RANKS, public_tokenizers.PATTERN)
    want = Counter()
    for r in odd_rows:
        ids = enc.encode_ordinary(r[1] or "")
        want[r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()] += 1
    assert multiset(op6.encode_digest(odd, RANKS, public_tokenizers.PATTERN).collect()) == want


def test_long_texts_in_chunk_rows(spark):
    """A text without white space gives many pieces; all of them are stitched back."""
    rng = random.Random(19)
    cjk = "".join(rng.choice("日本語文字列漢字") * rng.randint(1, 9) + rng.choice("。、！") for _ in range(70_000))[:400_000]
    enc = op6.encoder(RANKS, public_tokenizers.PATTERN)
    texts = [cjk, "word " * 30_000, "x" * 50_000 + " y" * 30_000, "a'b 1\n" * 20_000, "ß" * 40_000, " " * 70_000, "\n \n" * 30_000, cjk, "short", None, ""]
    docs = spark.createDataFrame([(i if i else None, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    pieces = op6.encoded_pieces(docs.where("doc_id is null"), RANKS, public_tokenizers.PATTERN).collect()
    assert len(pieces) > 20
    want = Counter()
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        want[i or None, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert multiset(op6.encode_digest(docs, RANKS, public_tokenizers.PATTERN).collect()) == want
    got = {r.doc_id: r.ids for r in op6.token_ids(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert all(got[i or None] == enc.encode_ordinary(t or "") for i, t in enumerate(texts))


def test_stitched_pieces_encode_as_one():
    enc = op6.encoder(RANKS, public_tokenizers.PATTERN)
    assert isinstance(enc, tiktoken.Encoding)
    rng = random.Random(6)
    parts = ["a", "don't", "'s", " ", "  ", "\n", "\n\n", "\t", "123", "é", "日本", "!?", "\x85", "\xa0", " ", "\x1c", "x" * 30, "<|endoftext|>"]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 120)))
        cuts = op6.stitch(text, public_tokenizers.PATTERN, 16, 12)
        ids = [i for a, b in zip(cuts, cuts[1:]) for i in enc.encode_ordinary(text[a:b])]
        assert ids == enc.encode_ordinary(text)
        assert enc.decode_bytes(ids) == text.encode()


def test_ids_decode_to_texts(spark, odd, odd_rows, empty):
    ids = op6.token_ids(odd, RANKS, public_tokenizers.PATTERN)
    back = op6.decode_ids(ids, RANKS, public_tokenizers.PATTERN)
    assert Counter((r.doc_id, bytes(r.bytes)) for r in back.collect()) == Counter((r[0], (r[1] or "").encode()) for r in odd_rows)
    assert op6.decode_ids(op6.token_ids(empty, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.bytes) for r in op6.decode_ids(nulls, RANKS, public_tokenizers.PATTERN).collect()] == [b"", b""]


def test_bpe_edges(empty, no_ids):
    assert op6.encode_digest(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    assert [len(r.ids) for r in op6.token_ids(no_ids, RANKS, public_tokenizers.PATTERN).collect()][-1] == 0


# 7 -----------------------------------------------------------------------------------


def test_mix_targets_and_amounts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = op7.mix(docs).collect()
    again = op7.mix(docs.repartition(5)).collect()
    texts = {r.doc_id: r for r in docs.collect()}
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        s = texts[r.doc_id].source
        assert r["size"] == len(brute.words(texts[r.doc_id].text)) and r.taken <= 2 * r["size"]
        sizes[s] += r["size"]
        taken[s] += r.taken
        target[s] = r.target
    want = brute.targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 0.03 * want[s]
    assert sum(a.taken != b.taken for a, b in zip(sorted(rows), sorted(again))) == 0


def test_mix_against_plain(spark):
    from test_pipeline import mixed

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = Counter(r["doc_id"] for r in mixed([r.asDict() for r in docs.collect()]))
    assert {r.doc_id: r.copies for r in op7.mix(docs).collect() if r.copies} == dict(want)


@pytest.mark.parametrize("short", [(10,), (10, 1)])
def test_mix_passes_over_a_long_document(spark, short):
    """One text with 30% of a source's words leaves no gap that a shorter one would fill, wherever it stands in the order."""
    for seed in range(4):
        docs, i = [], 0
        for s in "abc":
            for k in range(700):
                docs.append((i := i + 1, "w " * short[k % len(short)], s))
            docs.append((i := i + 1, "w " * int(0.3 / 0.7 * sum(d[1].count("w") for d in docs if d[2] == s)), s))
        rows = op7.mix(spark.createDataFrame(docs, "doc_id long, text string, source string"), seed=seed).collect()
        source = {d[0]: d[2] for d in docs}
        for s in "abc":
            own = [r for r in rows if source[r.doc_id] == s]
            left = [r["size"] for r in own if r.copies == int(r.target / r.source_size)]
            assert left and abs(sum(r.taken for r in own) - own[0].target) <= min(left), (s, seed)


def test_mix_edges(odd, odd_rows, empty, no_ids):
    rows = op7.mix(odd).collect()
    sizes = defaultdict(int)
    for r in odd_rows:
        sizes[r[3]] += len(brute.words(r[1]))
    want = brute.targets(sizes)
    assert sorted(r.target for r in rows) == pytest.approx(sorted(want[r[3]] for r in odd_rows))
    assert op7.mix(empty).count() == 0 and op7.mix(no_ids).count() == 3
    mixed = op7.mixed_documents(odd)
    assert mixed.columns == odd.columns and mixed.count() > 0


# 8 -----------------------------------------------------------------------------------


def test_deep_shallow_sort():
    rng = np.random.default_rng(1)
    strings = rng.integers(97, 99, (400, 30)).astype(np.uint8)
    strings[100:160] = strings[0]
    strings[160:200, :25] = strings[1, :25]
    lengths = np.full(400, 30)
    lengths[50:60] = 11
    strings[50:60, 11:] = 0
    groups = rng.integers(0, 3, 400)
    order, lcp = deep_shallow_sort(strings, lengths, groups, 8)
    want = sorted(range(400), key=lambda i: (groups[i], strings[i].tobytes(), lengths[i]))
    assert [(groups[i], strings[i].tobytes()) for i in order] == [(groups[i], strings[i].tobytes()) for i in want]
    for k in range(1, 400):
        a, b = order[k - 1], order[k]
        n = 0
        while n < min(lengths[a], lengths[b]) and strings[a][n] == strings[b][n]:
            n += 1
        assert lcp[k] == (n if groups[a] == groups[b] else 0)


def test_repeats_against_plain(odd, odd_rows):
    short = [r for r in odd_rows if r[0] != 205]
    got = op8.removal_digest(odd.where("doc_id <> 205")).collect()
    assert multiset(got) == multiset((r[0], *x) for r, x in zip(short, brute.removed([r[1] for r in short]), strict=True))


def test_repeats_of_all_kinds(spark):
    rng = random.Random(7)
    pool = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(150, 500))) for _ in range(6)]
    texts = []
    for _ in range(120):
        piece = lambda: rng.choice(["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 300))), rng.choice(pool)[rng.randint(0, 60) :], "xy" * rng.randint(0, 200), "a" * rng.randint(0, 400)])
        texts.append("".join(piece() for _ in range(rng.randint(0, 5))))
    texts += [None, "", texts[3], "z" + "\0" * 260, "é" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = multiset((i, *x) for i, x in enumerate(brute.removed(texts)))
    assert multiset(op8.removal_digest(docs).collect()) == want
    assert multiset(op8.removal_digest(docs, hot=3).collect()) == want  # most grams count as hot


def test_repeat_edges(odd, empty, no_ids):
    assert op8.removal_digest(empty).count() == 0 and op8.removal_digest(no_ids).count() == 3
    cut = op8.without_repeats(odd, counted="n_chars")
    assert cut.columns == odd.columns and cut.count() == odd.count()
    assert cut.where("text is null").count() == odd.where("text is null").count()


# 9 -----------------------------------------------------------------------------------


def test_media_payloads(odd, odd_rows, empty):
    got = op9.text_media(odd).collect()
    assert multiset(r[:8] for r in got) == multiset((r[0], *brute.payload(r[1]), *brute.media(r[1])) for r in odd_rows)
    assert len({(r.payload_sha256, r.media_sha256, r.feature) for r in got}) == len({r.payload_sha256 for r in got})
    assert op9.text_media(empty).count() == 0


def test_query_makes_every_tile(odd, odd_rows, tmp_path):
    from tidegrid.llm import queries

    odd.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op9_media_columns(odd.sparkSession, str(tmp_path)).collect()
    want = Counter()
    for r in odd_rows:
        image = np.frombuffer(op9.text_payload((r[1] or "").encode()), np.uint8).reshape(-1, 64)
        want[r[0], hashlib.sha256(op9.npy_tile(image)).hexdigest()] += 1
    assert Counter((r.doc_id, r.tile_sha256) for r in got) == want
    held = op9.measure_media(op9.store_media(odd)).collect()
    assert all(hashlib.sha256(r.tile).hexdigest() == r.tile_sha256 and np.load(__import__("io").BytesIO(r.tile)).shape == (32, 32) for r in held)


def test_image_formats():
    rng = np.random.default_rng(3)
    grey, colour = rng.integers(0, 256, (5, 7)).astype(np.uint8), rng.integers(0, 256, (4, 3, 3)).astype(np.uint8)
    assert (op9.decode(op9.encode_pgm(grey)) == grey).all() and (op9.decode(op9.encode_bmp(grey)) == grey).all()
    assert (op9.decode(b"P2 # comment\n7 5\n255\n" + b" ".join(b"%d" % x for x in grey.ravel())) == grey).all()
    assert (op9.decode(b"P6\n3 4\n255\n" + colour.tobytes()) == colour).all()
    assert (op9.decode(b"P3\n3 4\n255\n" + b" ".join(b"%d" % x for x in colour.ravel())) == colour).all()
    assert op9.decode(b"P1\n3 2\n1 0 1\n0 1 0\n").tolist() == [[0, 255, 0], [255, 0, 255]]
    assert op9.decode(b"P4\n3 2\n\xa0\x40").tolist() == [[0, 255, 0], [255, 0, 255]]
    for bad in (b"", b"P5\n3", b"P5\n9 9\n255\nxx", b"BM123", b"GIF"):
        with pytest.raises(ValueError):
            op9.decode(bad)


def test_area_resize_means():
    image = np.random.default_rng(4).integers(0, 256, (12, 18)).astype(np.uint8)
    assert np.allclose(op9.area_resize(image, 4, 6), image.reshape(4, 3, 6, 3).mean((1, 3)))
    assert np.allclose(op9.area_resize(image, 5, 7).mean(), image.mean())
    assert np.allclose(op9.area_resize(image, 24, 36)[::2, ::2], image)
    assert np.load(__import__("io").BytesIO(op9.npy_tile(image))).shape == (32, 32)


def test_media_features(spark):
    grey = np.arange(64, dtype=np.uint8).reshape(8, 8)
    media = spark.createDataFrame([("a", bytearray(op9.encode_pgm(grey))), ("b", bytearray(op9.encode_bmp(grey))), ("c", bytearray(b"junk")), ("d", None)], "name string, content binary")
    rows = {r.key: r for r in op9.media_features(media, key="name", content="content").collect()}
    assert rows["a"].dhash == rows["b"].dhash and rows["c"].dhash is None and rows["d"].tile is None


# 10 ----------------------------------------------------------------------------------


def test_shards(odd, odd_rows, empty, no_ids):
    rows = op10.shard_rows(odd).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert multiset((r.doc_id, r["size"], r.text_crc32) for r in rows) == multiset((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in odd_rows)
    assert multiset(rows) == multiset(brute.shards([(r[0], r[1]) for r in odd_rows])) == multiset(op10.shard_rows(odd.repartition(7)).collect())
    assert len({(r.doc_id, r.shard) for r in rows}) == len({r.doc_id for r in rows})
    assert op10.shard_rows(empty).count() == 0 and len({r.shard for r in op10.shard_rows(no_ids).collect()}) == 1


def test_many_equal_rows_are_numbered(spark, monkeypatch):
    monkeypatch.setattr(op10, "SUB_ROWS", 40)
    monkeypatch.setattr(op10, "RUN", 7)
    rows = [(None, "same")] * 500 + [(i, f"t{i % 9}") for i in range(900)] + [(4, "t4")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert multiset(op10.shard_rows(docs).collect()) == multiset(brute.shards(rows, sub_rows=40))


def test_rendezvous_weights(spark):
    df = spark.range(40_000).select(op10.rendezvous(__import__("pyspark").sql.functions.col("id"), [1, 2, 3]).alias("s")).groupBy("s").count().collect()
    share = {r.s: r["count"] / 40_000 for r in df}
    assert all(abs(share[k] - (k + 1) / 6) < 0.02 for k in range(3))


def test_bloom(spark):
    held = build(spark.range(0, 1000, 2).selectExpr("id * 7919 as k"))
    keys = np.arange(1000) * 7919
    hit = held.may_hold(keys)
    assert hit[::2].all() and hit[1::2].mean() < 0.05


def test_scratch_is_discarded(spark, tmp_path):
    import os

    from tidegrid.llm import runtime

    with runtime.passing(spark):
        first = runtime.staged(spark.range(3), "first")
        table = runtime.staged(spark.range(7), "demo")
    where = [df.inputFiles()[0].removeprefix("file://") for df in (first, table)]
    assert table.count() == 7 and all(runtime.scratch(spark).removeprefix("file://") in w for w in where)
    assert not os.path.exists(where[0]) and os.path.exists(where[1])
    assert runtime.scratch(spark.newSession()) == runtime.scratch(spark)
    runtime.discard(spark)
    assert not os.path.exists(runtime.scratch(spark).removeprefix("file://"))


# pipeline ------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for k, (_, stage) in enumerate(p.STAGES):
        out = stage(spark, docs, sf)
        if k < len(p.STAGES) - 1:
            assert out.columns == columns
        docs = spark.createDataFrame(out.collect(), out.schema)
    enc = op6.encoder(RANKS, public_tokenizers.PATTERN)
    assert docs.columns == ["doc_id", "ids"] and all(enc.decode_bytes(r.ids) is not None for r in docs.collect())


def test_pipeline_run(spark):
    import corpus_pipeline as p

    assert p.run(spark, "/root/testdata/sf0.001").count() > 0


# layouts, ties and long texts -----------------------------------------------------------


def test_results_do_not_depend_on_the_layout(spark, odd, monkeypatch):
    """The same rows in other partitions give the same results, also where many documents share a rank cell."""
    monkeypatch.setattr(op7, "CELLS", 8)
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choice("abcdefg") * rng.randint(1, 4) for _ in range(rng.randint(1, 90))), rng.choice("de"), rng.choice("xyz")) for i in range(1000)]
    rows += [rows[5]] * 40 + [(None, "one text of very many rows", "d", "x")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for query in (op7.mix, op2.language_query, op1.line_quality):
        a, b = (multiset(query(docs.repartition(n)).collect()) for n in (3, 7))
        assert a == b, query


def test_every_label_is_learned(spark):
    rng = random.Random(13)
    alphabets = [chr(0x4E00 + 40 * k) for k in range(70)]
    rows = [(i * 70 + k, "".join(chr(ord(a) + rng.randrange(30)) for _ in range(120)), f"l{k:02d}") for k, a in enumerate(alphabets) for i in range(12)]
    rows += [(100_000 + k, rows[0][1], "copies") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts, labels = op2.labelled_sample(docs.selectExpr("doc_id as id", "lang as label", "text"))
    assert len(set(labels)) == 71 and len(texts) == len(labels)
    assert {r.lang_pred for r in op2.language_query(docs).collect()} >= {f"l{k:02d}" for k in range(70)}


def test_excerpts_come_from_all_places(spark):
    text = "a" * 20_000 + "b" * 20_000
    docs = spark.createDataFrame([(i, text + str(i), "x") for i in range(40)], "id long, text string, label string")
    texts, _ = op2.labelled_sample(docs, sample_chars=100)
    assert all(len(t) == 100 for t in texts) and 5 < sum("b" in t for t in texts) < 35


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    import pyarrow as pa

    rng = random.Random(14)
    text = " ".join("".join(rng.choice("abc") for _ in range(rng.choice([1, 3, 9, 4000]))) for _ in range(400)) + "\nq w e\nq w e\n" + "z" * 9000
    column = pa.array([text, "short one", text[:50]], pa.string())
    want = op1.base_statistics(column), [K.shingle_sets(raw, offs) for _, _, raw, offs in K.chunks(column, 1)]
    weights = [np.bincount(op4.ngrams(raw, offs)[0], minlength=op4.BUCKETS + 1) for _, _, raw, offs in K.chunks(column, 1)]
    for block in (64, 1000):
        monkeypatch.setattr(K, "CHUNK_BYTES", block)
        got = op1.base_statistics(column), [K.shingle_sets(raw, offs) for _, _, raw, offs in K.chunks(column, 1)]
        assert all(a.equals(b) for a, b in zip(got[0], want[0]))
        assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(got[1], want[1]))
        for (_, _, raw, offs), w in zip(K.chunks(column, 1), weights):
            assert (sum(np.bincount(b, minlength=op4.BUCKETS + 1) for b, _ in op4.ngram_pieces(raw, offs, block)) == w).all()


def test_anchors_of_a_long_text_in_pieces(spark):
    rng = random.Random(15)
    text = "".join(rng.choice("ab \n") for _ in range(6000)) + "é" * 700 + "".join(rng.choice("ab") for _ in range(900))
    raw = np.frombuffer(text.encode(), np.uint8)
    offs = np.array([0, len(raw)])
    whole = op8._contexts(raw, offs)
    for piece in (300, 1111):
        parts = list(op8._context_pieces(raw, offs, piece))
        assert all((np.concatenate([p[k] for p in parts]) == whole[k]).all() for k in range(6))


def test_copies_of_a_text_are_sorted_once(spark, monkeypatch):
    """3,000 copies of one text in five partitions and five that share a passage: the sort gets a text's contexts once a partition."""
    rng = random.Random(16)
    passage = sentence_of(rng, 900)
    rows = [(i, passage + "tail of it all " * 3) for i in range(3000)]
    rows += [(5000 + k, sentence_of(rng, 300) + passage[k * 20 : k * 20 + 500] + sentence_of(rng, 300)) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    seen = []
    plain = op8.staged

    def watch(df, name, *a, **k):
        out = plain(df, name, *a, **k)
        seen.append((name, out.count()))
        return out

    monkeypatch.setattr(op8, "staged", watch)
    got = {r.doc_id: tuple(r)[1:] for r in op8.removal_digest(docs, hot=0).collect()}
    want = brute.removed([rows[0][1], rows[0][1]] + [t for _, t in rows[3000:]])
    assert got[0] == want[0] and [got[5000 + k] for k in range(5)] == want[2:]
    assert dict(seen)["op8-bodies"] <= 5 * dict(seen)["op8-contexts"] < 1500


def sentence_of(rng, n):
    return "".join(rng.choice("abcdefgh ") for _ in range(n))


def planted_pairs(rng, count):
    """Rows of pairs whose shingle sets have a Jaccard similarity between 0.85 and 0.95, as near to it as words allow."""
    rows = []
    for k in range(count):
        base = [f"p{k}w{i}" for i in range(rng.randint(60, 300))]
        n = len(base) - 4
        other = list(base)
        want = rng.uniform(0.85, 0.95)
        while True:  # the last words differ: each takes one shingle from both sets
            gone = len([1 for x, y in zip(base, other) if x != y]) + 1
            if (n - gone) / (n + gone) < want:
                break
            other[len(base) - gone] = f"q{k}w{gone}"
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
    return rows


def test_recall_of_planted_pairs(spark):
    rows = planted_pairs(random.Random(17), 2000)
    sets = [brute.shingles(t) for _, t in rows]
    near = [k for k in range(2000) if 100 * len(sets[2 * k] & sets[2 * k + 1]) >= 85 * len(sets[2 * k] | sets[2 * k + 1])]
    got = {r.doc_id: r.component_id for r in op5.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = [k for k in range(2000) if got[2 * k + 1] == 2 * k]
    assert len(near) > 1900 and found == near


def test_blocks_and_stars_lose_no_link(spark, monkeypatch):
    """Small blocks, so a bucket's minority spans several and stars go round."""
    rng = random.Random(18)
    rows = []
    for g in range(3):
        base = ["g%dw%d" % (g, i) for i in range(120)]
        for i in range(90):
            words = list(base)
            for p in rng.sample(range(120), rng.randint(0, 4)):
                words[p] = "x%d_%d" % (i, p)
            rows.append((1000 * g + rng.randrange(10**6), " ".join(words)))
    want = {r[0]: c for r, (_, c) in zip(rows, brute.near_components(rows), strict=True)}
    for block in (4, 50):
        monkeypatch.setattr(op5, "BLOCK", block)
        monkeypatch.setattr(op5, "LARGE", 1)
        got = {r.doc_id: r.component_id for r in op5.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == want

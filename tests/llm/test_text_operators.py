"""The text operators against brute force, libraries and round trips, with odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from compare import compare, duck
from tillwork.llm import (
    ORACLES,
    QUERIES,
    decontaminate,
    language,
    line_dedup,
    near_dedup,
    packing,
    shard,
    suffix_dedup,
    token_counts,
    token_files,
    topk,
)
from tillwork.llm.encoding import Encoder

public_tokenizers = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, score string"
LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))
ODD = [
    (1, None, None, None, None, "s", None),
    (2, "", "en", "a", 0, "s", "x"),
    (3, " \t\n ", "en", None, 4, None, None),
    (4, LONG, "en", "a", len(LONG), "s", "x"),
    (5, LONG, "en", "a", len(LONG), "s", "x"),
    (6, "the cat sat on the mat\n" * 6, "en", "a", 1, "s", "x"),
    (7, "the cat sat on the mat\n" * 6, "en", "a", 1, "s", "x"),
    (7, "the cat sat on the mat\n" * 6, "en", "a", 1, "s", "x"),
    (8, "aaaa" * 400, "de", "a", 1, "s", "x"),
    (9, "12 34 !!", "de", "a", 1, "s", "x"),
    (None, "the cat sat on the mat and looked at the dog for a while", None, None, None, None, None),
]
WORDS = ["", " ", "  ", "\n", "\t", "　", "a", "b", "'s", "the", "é", "12", "!", "<|endoftext|>", "Σ", "▁", "İ", "🙂"]


def texts(n=1500):
    draw = random.Random(3)
    return ["".join(draw.choice(WORDS) for _ in range(draw.randint(0, 12))) for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, small, name):
    ok, message, _ = compare(spark, duck(small), name, QUERIES[name], ORACLES[name], small)
    assert ok, message


# 1. token counts


@pytest.mark.parametrize("with_bytes", [True, False])
def test_piece_counts_are_those_of_the_library(with_bytes):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = token_counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    if not with_bytes:
        pieces = [p for p in pieces if not p[0].startswith("<0x")][:1500]
    library = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=with_bytes))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    counter = token_counts.PieceCounter(pieces)
    for text in texts():
        assert counter.text(text)[1] == len(library.encode(text, add_special_tokens=False).ids), text


def test_token_counts_of_odd_rows(odd, none):
    model = public_tokenizers.path("piece_bpe_32k.model")
    got = token_counts.count_tokens(odd, model).collect()
    assert len(got) == len(ODD) and set(odd.columns) - {"score"} <= set(got[0].asDict())
    assert [r["n_tokens"] for r in got if r["doc_id"] in (1, 2)] == [0, 0]
    assert token_counts.count_tokens(none, model).count() == 0


# 2. suffix arrays


def removed_by_hand(rows, n=suffix_dedup.LENGTH):
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - n + 1):
            first[data[i : i + n]] = min(first.get(data[i : i + n], doc), doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - n + 1):
            if first[data[i : i + n]] < doc:
                gone[i : i + n] = b"\1" * n
        spans = sum(1 for x in bytes(gone).split(b"\0") if x)
        kept = bytes(x for x, y in zip(data, gone) if not y)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [512, 1])
def test_repeated_strings(spark, odd, none, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_SHARDS", hot)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(120)
    rows = [(r[0], r[1]) for r in docs.collect()] + [(r[0] + 10_000, r[1]) for r in ODD if r[0]]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_repeated_strings(frame, shard_bytes=60_000).collect()
    assert sorted(tuple(r) for r in got) == removed_by_hand(rows)
    assert suffix_dedup.remove_repeated_strings(odd).count() == len(ODD)
    assert suffix_dedup.remove_repeated_strings(none).count() == 0


def test_suffix_array_and_common_prefixes():
    draw = random.Random(1)
    for text in (b"banana", b"a" * 300, bytes(draw.choice(b"ab") for _ in range(500)), b"\0\0\1\0\0"):
        order, words = suffix_dedup.suffix_array(text)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        shared = suffix_dedup.common_prefixes(order, words, 50, lane=16)
        for a, b in zip(order[:-1], order[1:]):
            n = 0
            while n < 50 and a + n < len(text) and b + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            assert shared[b] == n


# 3. decontamination


def test_passages_of_odd_rows(spark, odd, none):
    items = spark.createDataFrame(
        [(1, "On the MAT the cat"), (2, None), (3, ""), (10, "cat sat"), (10, "cat sat"), (None, "dog for")],
        "item_id long, text string",
    )
    got = {r["doc_id"]: r for r in decontaminate.contamination(odd, items).collect()}
    assert got[6]["item_ids"] == ["1", "10"] and got[None]["n_hit"] == 4 and got[1]["n_words"] == 0
    chunked = decontaminate.contamination(odd, items, chunk_bytes=200).collect()
    assert {r["doc_id"]: (r["n_hit"], r["item_ids"], r["spans"]) for r in chunked} == {
        d: (r["n_hit"], r["item_ids"], r["spans"]) for d, r in got.items()
    }
    near = {r["doc_id"]: r["n_hit"] for r in decontaminate.contamination(
        odd, spark.createDataFrame([(1, "cat on mat")], "item_id long, text string"), slop=2).collect()}
    assert near[6] > 0 and near[4] == 0
    assert decontaminate.contamination(none, items).count() == 0
    assert all(r["n_hit"] == 0 for r in decontaminate.contamination(odd, items.limit(0)).collect())


# 4. near duplicates


def test_near_duplicates_by_hand(spark, odd, none):
    draw = random.Random(5)
    base = [f"w{draw.randint(0, 5000)}" for _ in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 260):  # one group around the threshold, so that components need its members
        words = list(base)
        for _ in range(draw.randint(0, 14)):
            words[draw.randrange(len(words))] = f"v{draw.randint(0, 60)}"
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {d: set(near_dedup.Shingler(2).set_of(t).tolist()) for d, t in rows}
    label = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                n = len(sets[a] & sets[b])
                if label[a] < label[b] and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                    label[b], changed = label[a], True
    got = near_dedup.near_duplicates(frame, 2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == label
    assert len(set(label.values())) > 3
    rows = near_dedup.near_duplicates(odd, 2).collect()
    assert len(rows) == len(ODD)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[5]["component_id"] == 4 and by_id[7]["component_id"] == 6 and by_id[3]["component_id"] == 3
    assert by_id[None]["kept"] and by_id[1]["n_shingles"] == 0
    assert near_dedup.near_duplicates(none).count() == 0 and near_dedup.keep_one(none).count() == 0


def test_sketch_estimates_similarity():
    draw = np.random.default_rng(0)
    for size in (1, 5, 200):
        a = draw.integers(0, 2**63, size).astype(np.uint64)
        s = near_dedup.sketch(a)
        assert (s != np.iinfo(np.uint64).max).all() and (s == near_dedup.sketch(a[::-1])).all()
    a = draw.integers(0, 2**63, 900).astype(np.uint64)
    same = [np.mean(near_dedup.sketch(a[: 600]) == near_dedup.sketch(a[k : 600 + k])) for k in (0, 100, 300)]
    assert same[0] == 1 and abs(same[1] - 5 / 7) < 0.2 and abs(same[2] - 1 / 3) < 0.2


# 5. shards


def test_shards(spark, odd, none):
    frame = spark.range(1003).selectExpr("id as doc_id", "id % 7 as slot")
    got = shard.shuffle_into_shards(frame, ["doc_id"], shards=10).collect()
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(map(len, slots.values())) == [100] * 7 + [101] * 3
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert shard.shuffle_into_shards(odd, ["doc_id"], shards=3).count() == len(ODD)
    assert shard.shuffle_into_shards(none, ["doc_id"]).count() == 0


def test_large_hypergeometric_counts():
    draw = np.random.default_rng(2)
    got = [shard.hypergeometric(draw, 3 * 10**9, 10**9, 10_000) for _ in range(300)]
    assert abs(np.mean(got) - 7500) < 15 and 30 < np.std(got) < 60


# 6. lines


def test_repeated_lines_of_odd_rows(odd, none):
    got = {r["doc_id"]: r for r in line_dedup.remove_repeated_lines(odd).collect()}
    assert got[6]["text"] == "the cat sat on the mat\n" * 2 + "the cat sat on the mat\n"
    assert got[7]["n_removed_lines"] == 7 and got[7]["text"] == ""
    assert got[1]["text"] is None and got[4]["text"] == LONG
    assert line_dedup.remove_repeated_lines(none).count() == 0


# 7. top k


def test_top_k_by_hand(spark):
    draw = np.random.default_rng(4)
    rows = [(i, draw.integers(-3, 4, 6).astype(float).tolist()) for i in range(300)]
    rows += [(300, rows[0][1]), (301, []), (302, None), (303, [float("nan")] * 6), (304, [1.0, None]), (None, [1.0])]
    frame = topk.quantised(spark.createDataFrame([*rows, rows[5]], "vec_id long, embedding array<double>"))
    got = topk.top_k(frame.where("vec_id % 50 = 0"), frame, 5, block=64, queries_at_once=2).collect()
    real = {i: np.array((v + [0.0] * 6)[:6]) * 256 for i, v in rows[:302]}
    for q in (0, 50, 300):
        scores = sorted((-int(real[q] @ v), i) for i, v in real.items() if i != q)[:5]
        assert [(-r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == scores
    assert topk.top_k(frame.limit(0), frame).count() == 0
    lists = topk.SortedLists(np.arange(5000), draw.normal(size=(5000, 3)).round(3) * 1000)
    assert lists.top(-1, np.array([1.0, 2.0, -1.0]), 5)[2] < 5000  # it stops early


# 8. token files


def test_ids_are_those_of_the_library():
    from tokenizers import Tokenizer

    for name, glues in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        mine, library = Encoder(public_tokenizers.path(name), glues), Tokenizer.from_file(public_tokenizers.path(name))
        for text in texts():
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(mine.encode(text), "<u4").tolist() == want, text


def test_files_round_trip(spark, odd, none, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_ids(odd, str(tmp_path / "ids"), path, end_id=2)
    got = token_files.documents_in(spark, str(tmp_path / "ids")).orderBy("start").collect()
    assert len(got) == len(ODD) and got[0]["start"] == 0 and got[0]["doc_id"] is None
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(got, got[1:]))
    assert [r["n_tokens"] for r in got if r["doc_id"] == 2] == [1]
    assert [r["ids_crc32"] for r in got if r["doc_id"] == 1] == [zlib.crc32(np.array([2], "<u4").tobytes())]
    token_files.write_ids(none, str(tmp_path / "none"), path, end_id=2)
    assert token_files.documents_in(spark, str(tmp_path / "none")).count() == 0


# 9. packing


def test_bins():
    draw = random.Random(9)
    for bins in (1, 4, 100):
        fit, fill = packing.BestFit(100, bins), {}
        for _ in range(2000):
            size = draw.randint(1, 100)
            found, offset = fit.place(size)
            assert offset == fill.get(found, 0)
            fill[found] = offset + size
            assert fill[found] <= 100 and fit.open <= bins


def test_packing_of_odd_rows(odd, none):
    got = packing.packed(odd).collect()
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= packing.LENGTH and len({(r["doc_id"]) for r in got}) == 10
    assert packing.packed(none).count() == 0


def test_large_groups_are_packed_as_densely_as_small_ones(spark):
    draw = np.random.default_rng(9)
    lengths = np.minimum(packing.LENGTH, draw.lognormal(6.3, 0.8, 120_000).astype(int) + 1).tolist()
    pieces = spark.createDataFrame(
        [(i, 0, 0, n) for i, n in enumerate(lengths)], "doc_id long, copy long, piece int, length long"
    )
    rows = packing.pack(pieces).collect()
    ends, fullest = {}, -(-sum(lengths) // packing.LENGTH)
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert sorted(r["length"] for r in rows) == sorted(lengths)
    assert max(ends.values()) <= packing.LENGTH and len(ends) <= 1.003 * fullest


@pytest.mark.parametrize("bins", [1, 2, 7])
def test_runs_never_need_more_bins_than_may_be_open(bins):
    draw = random.Random(bins)
    lengths = np.array([draw.randint(1, 100) for _ in range(3000)])
    spans = list(packing.runs(lengths, max(100, bins * 100 // 2)))
    assert [a for a, _ in spans] == [0, *(b for _, b in spans[:-1])] and spans[-1][1] == len(lengths)
    for at, to in spans:
        fit = packing.BestFit(100, bins)
        for n in sorted(lengths[at:to].tolist(), reverse=True):
            fit.place(n)
        assert fit.made <= bins


# 10. languages


def test_languages(spark, small, odd, none):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = QUERIES["op10_language_id"](spark, small).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.95
    model = language.fit(docs)
    rows = {r["doc_id"]: r for r in language.identify(odd, model).collect()}
    assert {rows[d]["lang_pred"] for d in (1, 2, 3, 9)} == {"und"} and 0 <= rows[4]["score"] <= 1
    assert language.identify(odd, language.fit(none)).where("lang_pred <> 'und'").count() == 0


def test_first_ids_of_each_language(spark):
    from pyspark.sql import functions as F

    rows = [(i, "many") for i in range(4000)] + [(i, "few") for i in range(7)] + [(5, "one")] * 900
    rows += [(i, "rare") for i in range(2)]
    ids = spark.createDataFrame(rows, "doc_id long, lang string").repartition(5)
    hashed = ids.withColumn("h", F.xxhash64(F.lit("language"), "doc_id")).collect()
    found = language.first_by_hash(ids, 10, 3)
    for name, size in (("many", 10), ("few", 7), ("one", 10)):
        expected = sorted((r["h"], r["doc_id"]) for r in hashed if r["lang"] == name)[:size]
        own = sorted((r["__rank"], r["__id"]) for r in found if r["__lang"] == name)
        assert [x for _, x in own] == [x for _, x in expected]
    assert {r["__lang"] for r in found} == {"many", "few", "one"}
    assert language.first_by_hash(ids.limit(0), 10, 3) == []


def test_every_label_is_learned(spark):
    rows = [
        (i, " ".join(f"{chr(97 + i % 230 // 15)}{chr(97 + i % 230 % 15)}q" for _ in range(6)), f"l{i % 230:03}")
        for i in range(230 * 8)
    ]
    rows += [(10_000 + i, "zzx xzz zxz xxz", "zz") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language.fit(docs)
    assert set(model.languages) == {r[2] for r in rows}
    got = language.identify(docs, model).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got if r["lang"] == "zz"]) == 1
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.9
    sizes = [language.share(n) for n in (0, 1, 200, 400, 10**6)]
    assert sizes == [800, 800, 800, 400, language.LEAST]


def test_rows_of_a_repeated_id_do_not_grow_the_sample(spark, monkeypatch):
    rows = [(3, f"der alte hund {i}", "de") for i in range(300)] + [(3, "12 34", "de")] * 50
    rows += [(i, f"the old dog {i}", "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    monkeypatch.setattr(language, "SAMPLE", 30)
    monkeypatch.setattr(language, "CALIBRATION", 10)
    seen, train = [], language.train

    def counted(examples, *rest):
        seen.append(len(examples))
        return train(examples, *rest)

    monkeypatch.setattr(language, "train", counted)
    sizes = []
    monkeypatch.setattr(language, "fit_temperature", lambda logits, labels: sizes.append(len(labels)) or 1.0)
    assert set(language.fit(docs).languages) == {"de", "en"}
    assert seen[0] + sizes[0] <= 2 * (30 + 10)


def test_pipeline(spark, small):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, small).collect()
    kept = {r["doc_id"] for r in out}
    assert 100 < len(kept) <= 200
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == corpus_pipeline.COLUMNS


def test_arrow_rows_table_is_empty_without_rows():
    assert suffix_dedup.rows_table([]).num_rows == 0 and isinstance(suffix_dedup.rows_table([]), pa.Table)

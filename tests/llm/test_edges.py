"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import random
import re

import numpy as np
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

import public_tokenizers
from corpus_pipeline import STAGES
from dunlin.llm.ann import LEAST_LISTS, CentroidGraph, nearest_neighbours
from dunlin.llm.bpe import Codec, SharedCodec, decode_ids, encode_texts, read_ranks
from dunlin.llm.chat import format_chat, read_chat
from dunlin.llm.license_scan import license_scan, rules
from dunlin.llm.merkle import merkle_manifest
from dunlin.llm.mixing import mix_schedule, mix_sources, source_targets, token_count
from dunlin.llm.ngram_join import ngram_jaccard_components
from dunlin.llm.period_runs import find_runs, periodic_runs
from dunlin.llm.quality_classifier import fit_quality, score_quality
from dunlin.llm.quality_rules import quality_rules
from dunlin.llm.shingles import CHUNK, shingle_sets, word_codes
from dunlin.llm.simhash import BKTrees, near_links, simhash_components
from dunlin.llm.url_rules import RULES, ShiftAnd, canonical, host_and_path, url_verdicts
from dunlin.llm.warc import HEAD_BYTES, read_warc, write_warc
from dunlin.session import materialize, new_path
from tests.llm import brute

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
KIND = "doc_id long, text string, source string, key string, kept string, words string"


def made_texts(seed=1):
    rng = random.Random(seed)
    vocabulary = ["cc", "by", "all", "rights", "reserved", "general", "public", "license", "Été", "ß", "x#y", "A"]
    vocabulary += [f"w{i}" for i in range(200)]
    texts = [None, "", "   \n\t", "one", "one two three four", "\u00a0", "All Rights Reserved. CC-BY cc by cc by"]
    texts += [" ".join(rng.choices(vocabulary, k=rng.randint(1, 120))) for _ in range(40)]
    base = rng.choices(vocabulary, k=200)
    for _ in range(25):
        near = list(base)
        for _ in range(rng.randint(0, 6)):
            near[rng.randrange(200)] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(near))
    texts += [" ".join(f"u{i}" for i in range(30_000)), "same line\nsame line\n" * 3000, "z" * 70_000]
    return texts + texts[:12]


def frame(spark, seed=1):
    rng = random.Random(seed)
    texts = made_texts(seed)
    rows = [(None if i % 29 == 7 else i, t, rng.choice(["a", "b", None, "é"]), "k", "q", "w") for i, t in enumerate(texts)]
    rows += rows[:5]
    return spark.createDataFrame(rows, KIND), rows


def test_word_codes_do_not_depend_on_chunks():
    long = b"word " * (CHUNK // 4) + b"x" * (CHUNK + 100) + b" end"
    codes = word_codes(long)
    assert len(codes) == CHUNK // 4 + 2 and len(set(codes.tolist())) == 3
    assert codes[0] == word_codes(b"WORD")[0] and codes[-1] == word_codes(b"end")[0]
    texts = [b"a b c d e f", None, b"", b"a b", long, b"a b c d e f"]
    sets = list(shingle_sets(texts))
    assert [len(s) for s in sets[:4]] == [2, 0, 0, 1] and (sets[0] == sets[5]).all()
    assert (sets[4] == next(shingle_sets([long]))).all()


def test_ngram_join(spark):
    df, rows = frame(spark)
    got = ngram_jaccard_components(df).select("id", "n_shingles", "component_id").collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == brute.components([r[:2] for r in rows])
    assert ngram_jaccard_components(df.limit(0)).count() == 0
    assert ngram_jaccard_components(df.where("text is null")).where("n_shingles <> 0").count() == 0


def test_ngram_join_of_a_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(400):
        near = list(base)
        for _ in range(rng.randint(0, 5)):
            near[rng.randrange(120)] = f"n{rng.randrange(10**6)}"
        rows.append((i, "Common line of every text here.\n" + " ".join(near)))
    rows += [(1000 + i, "Common line of every text here.\n" + " ".join(f"d{i}x{j}" for j in range(40))) for i in range(200)]
    got = ngram_jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.select("id", "n_shingles", "component_id").collect())) == brute.components(rows)


def test_ngram_join_of_columns_of_many_unlinked_rows(spark, monkeypatch):
    """Columns of a thousand rows that no pivot joins: chains of near copies, strangers with a passage in common."""
    from dunlin.llm import ngram_join

    rng = random.Random(6)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + [f"s{i}x{j}" for j in range(rng.randint(3, 60))])) for i in range(900)]
    for c in range(8):  # each text is near the one before it only
        words = [f"c{c}x{j}" for j in range(150)]
        for i in range(40):
            words = list(words)
            for _ in range(2):
                words[rng.randrange(150)] = f"e{rng.randrange(10**7)}"
            rows.append((10_000 + 100 * c + i, " ".join(passage + words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.components(rows)
    assert 100 < len({c for _, _, c in want}) < 1000
    for block, cells, part in ((4096, 1 << 19, (256, 2048)), (100, 1 << 19, (7, 50)), (4096, 30_000, (256, 2048))):
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        monkeypatch.setattr(ngram_join, "CELLS", cells)
        monkeypatch.setattr(ngram_join, "PART", part)
        got = ngram_jaccard_components(df).select("id", "n_shingles", "component_id").collect()
        assert sorted(map(tuple, got)) == want


def test_quality_rules(spark):
    df, rows = frame(spark)
    got = quality_rules(df, keep=("doc_id", "text", "key")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(r.text)
    assert quality_rules(df.limit(0), keep=("doc_id",)).count() == 0


@pytest.mark.parametrize("null_sources", [False, True])
def test_mixing(spark, null_sources):
    df, rows = frame(spark, 3)
    if null_sources:
        df, rows = df.withColumn("source", F.lit(None).cast("string")), [(*r[:2], None, *r[3:]) for r in rows]
    got = mix_sources(df, token_count(F.col("text")), keep=("doc_id", "text", "words"), block_tokens=64)
    found = got.withColumn("w", F.col("words")).collect()
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + len(brute.words(r[1]))
    want = brute.targets(sizes)
    assert len(found) == len(rows)
    assert sorted({round(r.target, 6) for r in found}) == sorted({round(t, 6) for t in want.values()})
    assert abs(sum(r.taken for r in found) - sum(want.values())) <= len(want)
    for r in found:
        assert r["size"] == len(brute.words(r.text)) and 0 <= r.taken <= 3 * r["size"]
    assert mix_sources(df.limit(0), token_count(F.col("text")), keep=("doc_id",)).count() == 0
    none = mix_sources(df.where("text is null"), token_count(F.col("text")), keep=("doc_id",)).collect()
    assert all(r.taken == 0 and r.target == 0 for r in none)


def test_mix_schedule_is_balanced_and_whole(spark):
    rows = [(i, ("a", "b", "c", None)[i % 7 % 4], 1 + i * 37 % 90) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long")
    got = mix_schedule(df, F.col("n"), keep=("doc_id",), block_tokens=64).orderBy("slot", "block_from").collect()
    taken = {r.doc_id: r.taken for r in mix_sources(df, F.col("n"), keep=("doc_id",), block_tokens=64).collect()}
    summed, slots, readings = dict.fromkeys(taken, 0), {}, {}
    for r in got:
        summed[r.doc_id] += r.block_to - r.block_from
        slots.setdefault(r.slot, []).append(r)
        readings.setdefault((r.doc_id, r.turn), []).append(r)
    assert summed == taken
    assert list(slots) == list(range(len(slots)))  # no gaps
    for pieces in slots.values():  # one block each, its tokens in turn
        assert len({(r.source, r.block) for r in pieces}) == 1 and pieces[0].block_from == 0
        assert all(a.block_to == b.block_from for a, b in zip(pieces, pieces[1:]))
    for pieces in readings.values():
        assert sum(r.block_to - r.block_from for r in pieces) == pieces[0].read <= pieces[0]["size"]
        at = 0
        for r in sorted(pieces, key=lambda r: r.doc_from):
            assert r.doc_from == at
            at += r.block_to - r.block_from
    needs, seen = {}, {}
    for pieces in slots.values():
        needs[pieces[0].source] = needs.get(pieces[0].source, 0) + 1
    for slot, pieces in slots.items():  # a source's blocks in order, each prefix near the targets
        s = pieces[0].source
        assert pieces[0].block == seen.get(s, 0)
        seen[s] = seen.get(s, 0) + 1
        assert all(abs(seen.get(x, 0) - (slot + 1) * n / len(slots)) <= 4 for x, n in needs.items())
    again = mix_schedule(df.repartition(5), F.col("n"), keep=("doc_id",), block_tokens=64)
    assert again.orderBy("slot", "block_from").collect() == got


def test_quality_bound_counts_labels_with_documents(spark):
    learned = [i for i in range(3000) if not brute.held_out(i)]
    labels = [(i, int(i % 4 > 0)) for i in learned]
    docs = spark.createDataFrame([(i, "one and the same text") for i in learned[-400:]], "doc_id long, text string")
    model = fit_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"), per_class=5)
    # Labels without a document take no places, and votes keep the shares of all 400.
    assert sorted(model.labels.tolist()) == [0] * 5 + [1] * 5
    ones = sum(q for _, q in labels[-400:])
    assert model.scores([b"one and the same text"])[0] == pytest.approx(ones / 400)


def test_pipeline_mix_is_in_slot_order(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = mix_schedule(docs, token_count(F.col("text")), keep=("doc_id",)).orderBy("slot", "block_from").collect()
    want = [r.doc_id for r in pieces if r.doc_from == 0 and 2 * r.read >= r["size"]]
    stage = dict(STAGES)["mix_sources"]
    assert [r.doc_id for r in stage(spark, docs, sf_dir).collect()] == want


def test_targets_stop_at_three_times_a_source(spark):
    rows = [("a", 1), ("b", 1000), ("c", 10), (None, 500), ("", 0)]
    got = source_targets(spark.createDataFrame(rows, "source string, source_size long"))
    want = brute.targets(dict(rows))
    assert {r.source: pytest.approx(r.target) for r in got.collect()} == want


def test_quality_votes_are_calibrated():
    """Few bad rows among many good ones: the vote that parts them becomes the cut."""
    from dunlin.llm import quality_classifier as q

    assert q.best_cut(np.array([0.5, 0.6, 0.9, 1.0]), np.array([0, 0, 1, 1])) == pytest.approx(0.75)
    assert q.best_cut(np.array([0.1, 0.9]), np.array([0, 1])) == q.CUT  # parted already
    assert q.best_cut(np.array([0.5, 0.5, 0.5]), np.array([0, 1, 1])) == q.CUT
    assert q.best_cut(np.zeros(0), np.zeros(0)) == q.best_cut(np.ones(3), np.ones(3)) == q.CUT
    rng = np.random.default_rng(2)
    rows = np.zeros((200, q.WIDTH), np.float32)
    rows[:, :60] = rng.random((200, 60)) * 0.4
    labels = (np.arange(200) >= 20).astype(int)
    rows[labels == 0, 3] += 1.2
    model = q.NeighbourModel(np.ones(q.WORDS), rows, labels, np.ones(200))
    plain = []
    for i in range(200):  # the vote of the nearest others, one row at a time
        cosine = model.vectors @ model.vectors[i]
        near = [j for j in np.argsort(-cosine, kind="stable") if j != i][: q.NEIGHBOURS]
        weight = np.maximum(cosine[near], 1e-3).astype(float) ** q.SHARPNESS
        plain.append(float((weight * labels[near]).sum() / weight.sum()))
    assert model._left_out_votes() == pytest.approx(np.array(plain), abs=1e-4)
    cut = np.interp(plain, [0, model.cut, 1], [0, q.CUT, 1]) >= q.CUT
    assert (cut == labels).mean() >= 0.95


def test_quality_classifier(spark):
    df, rows = frame(spark)
    labels = [(r[0], int((r[0] or 0) % 3 > 0), 0) for r in rows] + [(None, 1, 0), (3, None, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0), labels.where("quality = 1")):
        got = score_quality(df, fit_quality(df, known)).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert score_quality(df.limit(0), fit_quality(df.limit(0), labels)).count() == 0


def test_url_rules(spark):
    urls = [None, "", "nothing", "http://net", "http://net/", "HTTP://A.NET/x?y", "x://example.net/en/1#f", "http://example.net?/en/"]
    urls += ["http://sub.EXAMPLE.com/de/", "http://notexample.com/de/", "http://org/fr/", "a://b://c.org/fr/", "http://É.org/fr/é"]
    urls += ["http://x.org/spam.net/", "http://net:80/", "http://a.net/" + "y" * 30_000, "http://x/*", "http:///net/"]
    df = spark.createDataFrame([(i, u, "r", "v") for i, u in enumerate(urls + urls)], "page_id long, url string, rule string, verdict string")
    got = url_verdicts(df).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        host, path, rule, verdict = brute.url_rule(urls[r.id % len(urls)], RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or ("block" if "spam" in path else "allow"))
    assert url_verdicts(df.limit(0)).count() == 0


def test_shift_and_matches_like_globs():
    from fnmatch import fnmatchcase

    rng = random.Random(2)
    globs = ["".join(rng.choices("ab*", k=rng.randint(1, 9))) for _ in range(60)] + ["*", "**", "a" * 70, "*" + "ab" * 40 + "*"]
    texts = ["".join(rng.choices("ab", k=rng.randint(0, 14))) for _ in range(300)] + ["a" * 70, "b" + "ab" * 41, ""]
    hit = ShiftAnd([g.encode() for g in globs]).match([t.encode() for t in texts])
    assert [[bool(x) for x in row] for row in hit] == [[fnmatchcase(t, g) for g in globs] for t in texts]


def test_shift_and_with_thousands_of_globs():
    from fnmatch import fnmatchcase

    rng = random.Random(6)
    globs = ["*" + "".join(rng.choices("abc", k=rng.randint(3, 7))) + rng.choice(("", "*", "*a*", "/*")) for _ in range(3000)]
    texts = ["".join(rng.choices("abc/", k=rng.randint(0, 40))) for _ in range(200)]
    machine = ShiftAnd([g.encode() for g in globs])
    assert len(machine.first) > 200  # words of 64 bits
    hit = machine.match([t.encode() for t in texts])
    assert hit.tolist() == [[fnmatchcase(t, g) for g in globs] for t in texts] and hit.any(axis=0).sum() > 500
    assert machine.match([]).shape == (0, 3000)


def test_globs_read_the_canonical_url(spark):
    same = {
        "http://user:pass@Shop.ORG.:8080//a/./b/../%43asino?q": b".shop.org\xff/a/casino",
        "http://shop.org:/a/..": b".shop.org\xff/",
        "http://shop..org/%2563%61sino/": b".shop.org\xff/casino/",
        "http://%73hop.org": b".shop.org\xff",
        "http://shop.org/../../a%2Fb%": b".shop.org\xff/a/b%",
        "http://shop.org/\u00c9%C3%89%FFx%F8": b".shop.org\xff/\xc3\x89\xc3\x89x",
        "http:///": b".\xff/",
        "no scheme": b".\xff",
    }
    for url, whole in same.items():
        assert canonical(*host_and_path(url)) == whole, url
    hidden = ["http://a.org/%63asino", "http://a.org/CASINO", "http://a.org/ca%09sino", "http://a.xxx:99/", "http://a.xxx./", "http://a.org/x/%2e%2e/ads/1"]
    plain = ["http://a.org/ok?casino", "http://a.xxx.org/", "http://a.org/ads", "http://casin.org/o", "http://a.org/%63asin"]
    ruled = {"http://A.net:80/CASINO": None, "http://a.org/fr/%63asino": "org/fr/", "http://a.org/x/../fr/casino": None, "http://a.net/casino": "net/"}
    urls = hidden + plain + list(ruled)
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {urls[r.id]: r for r in url_verdicts(df).collect()}
    assert [got[u].verdict for u in hidden + plain] == ["block"] * len(hidden) + ["allow"] * len(plain)
    assert {u: got[u].rule for u in ruled} == ruled
    assert [got[u].verdict for u in ruled] == ["block", "allow", "block", "block"]
    assert got["http://A.net:80/CASINO"].host == "a.net:80" and got["http://A.net:80/CASINO"].path == "/CASINO"


def test_license_scan(spark):
    df, rows = frame(spark)
    got = license_scan(df, keep=("doc_id", "text", "words")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.license(r.text)
    assert license_scan(df.limit(0), keep=("doc_id",)).count() == 0


def test_license_rules_suppress_what_they_contain(spark):
    assert len(rules()) >= 200
    texts = {
        "Licensed under the Apache License, Version 2.0 today": "apache-2.0",
        "GNU Lesser General Public License version 2.1 or later": "gpl,lgpl-2.1+",
        "(c) CC BY-SA 4.0": "cc-by,cc-by-sa-4.0",
        "permission is hereby granted, free of charge, to any person obtaining a copy": "mit",
    }
    df = spark.createDataFrame(list(texts), "string").withColumnRenamed("value", "text")
    assert {r.text: r.labels for r in license_scan(df, keep=("text",)).collect()} == texts


def test_warc(spark):
    rows = [(i, f"http://h/{i}\r\nX: y", f"<p>{i % 7}</p>" * (i % 5), "x") for i in range(200)]
    rows += [(None, None, None, None), (500, None, None, "x"), (None, "u", "alone", "x"), (7, "u", "\u20ac" * 200_000, "x"), *rows[:3]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, sha string")
    key = lambda r: tuple((x is None, x) for x in r)
    archives = []
    for parts in (1, 5):
        folder = new_path(spark, "warc-test")
        manifest = write_warc(df.repartition(parts), folder, shard_bytes=2000, roll_bytes=1500)
        got = read_warc(spark, folder)
        assert got.where(~F.col("intact")).count() == 0
        assert sorted(map(tuple, got.drop("intact").collect()), key=key) == sorted(brute.warc([(r[0], r[2]) for r in rows]), key=key)
        archives.append(sorted((r.file, r.records, r.sha1) for r in manifest.collect()))
    assert archives[0] == archives[1] and len(archives[0]) > 3
    folder = new_path(spark, "warc-test")
    assert write_warc(df.limit(0), folder).count() == 0


def test_warc_shards_hold_equal_bytes(spark):
    """Sizes that grow with the id: shards of equal row counts would differ forty times."""
    rng = random.Random(9)
    rows = [(i, f"http://a/{i}", "".join(rng.choices("abcdefgh", k=20 + 10 * i))) for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = new_path(spark, "warc-test")
    manifest = write_warc(df, folder, shard_bytes=50_000).collect()
    got = {r.id: r for r in read_warc(spark, folder).collect()}
    at, raw = 0, []
    for shard, records in sorted((r.shard, r.records) for r in manifest):
        raw.append(sum(HEAD_BYTES + len(html) for _, _, html in rows[at : at + records]))
        at += records
    assert at == 400 and len(got) == 400 and all(r.intact for r in got.values())
    assert len(raw) == -(-sum(HEAD_BYTES + len(r[2]) for r in rows) // 50_000)
    assert all(abs(b - 50_000) <= HEAD_BYTES + 4010 for b in raw[:-1])


def test_chat(spark):
    nasty = ["<|im_end|>", "<\\|x", "<\\\\|", "a\nb", "\\", "<|im_start|>assistant\n", "", None, "é<|", "<<||>>", "$1\\$"]
    rng = random.Random(4)
    roles = ["user", "assistant", "system", "tool\nx", "\\n", "<|im_end|>", None]
    rows = [(c, t if t % 5 else None, rng.choice(roles), "".join(x or "" for x in rng.choices(nasty, k=4)), "l") for c in range(30) for t in range(6)]
    rows += [(None, 0, "user", None, "l"), (99, 0, "user", "hi", "l"), (99, 1, "assistant", "x" * 100_000, "l"), *rows[:4]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss string")
    segments = format_chat(df)
    got = read_chat(segments).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute.chat([r[:4] for r in rows])
    assert {r.conv_id: r.valid for r in got}[99] is True
    assert segments.where("kind = 'text'").where(F.contains("text", F.lit("<|"))).count() == 0
    assert read_chat(format_chat(df.limit(0))).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.round(rng.standard_normal(8), 1)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(100)] + rows[:10]
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [None] + [1.0] * 7), (2060, [float("nan")] * 8), (2080, [1.0]), (2100, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, list int")
    plain = [r for r in dict((i, (i, v)) for i, v in rows).values() if r[1] is None or len(r[1]) == 8]
    want = brute.nearest(plain)
    got = {}
    for r in nearest_neighbours(df, df.where("vec_id % 20 = 0"), 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert sum(len(set(got[q]) & {v for v, _ in want[q]}) for q in want) >= 0.9 * 20 * len(want)
    few = nearest_neighbours(df.limit(5), df.limit(1), 20).collect()
    assert [r["rank"] for r in few] == [1, 2, 3, 4]
    assert nearest_neighbours(df.limit(0), df.limit(0)).count() == 0


def test_queries_on_a_centroid_read_more_than_its_list(spark):
    """Copies of a direction in tight groups: the distance to the nearest centroid says nothing about the others."""
    rng = np.random.default_rng(8)
    centers = rng.standard_normal((60, 12))
    x = np.concatenate([c + 0.002 * rng.standard_normal((30, 12)) for c in centers] + [rng.standard_normal((400, 12))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph = CentroidGraph(np.concatenate([x, np.zeros((len(x), 1))], axis=1), 80)
    assert all(len(graph.lists_to_read(c)) >= min(LEAST_LISTS, len(graph.centers)) for c in graph.centers)
    order = rng.permutation(len(x)).tolist()
    rows = [(i, x[j].tolist()) for i, j in enumerate(order)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want, found = brute.nearest(rows), {}
    for r in nearest_neighbours(df, df.where("vec_id % 20 = 0"), 20).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = [len(found[q] & {v for v, _ in want[q]}) for q in want]
    assert len(hits) == 110 and sum(hits) >= 0.9 * 20 * len(hits) and min(hits) >= 10


def test_centroid_walk_finds_the_near_centroids():
    rng = np.random.default_rng(0)
    graph = CentroidGraph(rng.standard_normal((3000, 6)), 200)
    hits = 0
    for q in rng.standard_normal((50, 6)):
        exact = np.argsort(((graph.centers - q) ** 2).sum(axis=1))[:10]
        hits += len(set(exact) & set(graph.walk(q)[1][:10]))
    assert hits >= 0.95 * 500


def coder():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=read_ranks(VOCABULARY))


def test_bpe_equals_the_library_on_hard_texts():
    rng = random.Random(6)
    codec, want = Codec(read_ranks(VOCABULARY), public_tokenizers.PATTERN), coder()
    alphabets = ["ab", "the in on ", "aA1 .,'\n\t", "é漢字 x'sre", " \n\r\t\u00a0", "0123456789", "=-_*#", "'reveslmtd "]
    texts = ["".join(rng.choices(a, k=rng.randint(0, n))) for a in alphabets for n in (5, 60, 400) for _ in range(30)]
    texts += ["a" * 5000, "ab" * 4000, " " * 3000 + "x", "\n" * 2001, "the" * 3000, "漢" * 2000, "<|endoftext|>"]
    for t in texts:
        ids = codec.encode(t)
        assert ids.tolist() == want.encode_ordinary(t), repr(t[:80])
        assert codec.decode(ids) == t.encode()


def test_bpe_split_is_joined_from_halves(monkeypatch):
    from dunlin.llm import bpe

    monkeypatch.setattr(bpe, "LEAF_CHARS", 7)
    monkeypatch.setattr(bpe, "LEAF_BYTES", 4)
    monkeypatch.setattr(bpe, "LEAF_TOKENS", 3)
    codec, want = Codec(read_ranks(VOCABULARY), public_tokenizers.PATTERN), coder()
    rng = random.Random(7)
    plain = regex.compile(public_tokenizers.PATTERN)
    for a in ("ab 'rev's\n", "we'll they've 12 .", " \n\t x", "the and ing é "):
        for _ in range(150):
            t = "".join(rng.choices(a, k=rng.randint(8, 90)))
            assert codec._split(t) == plain.findall(t), repr(t)
            ids = codec.encode(t)
            assert ids.tolist() == want.encode_ordinary(t), repr(t)
            assert codec.decode(ids) == t.encode()


def test_bpe_rows(spark):
    df, rows = frame(spark)
    codec = SharedCodec(spark, VOCABULARY, public_tokenizers.PATTERN)
    got = decode_ids(encode_texts(df.withColumn("ids", F.lit(1)), codec), codec).collect()
    want = coder()
    assert len(got) == len(rows)
    held = sorted(((r[0] is None, r[0] or 0, want.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in rows))
    assert sorted(((r.id is None, r.id or 0, list(r.ids), bytes(r.decoded)) for r in got)) == held
    assert encode_texts(df.limit(0), codec).count() == 0


def stage_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


def test_pipeline_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    extra = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit(None).cast("string"))
    docs = docs.unionByName(extra).unionByName(docs.limit(4))
    for name, stage in STAGES:
        rows = stage_rows(docs.select(*columns))
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name
        docs = materialize(stage(spark, docs, sf_dir), name)
        assert docs.count() > 0
        if name != "byte_bpe":
            assert docs.columns == columns
        if name == "quality_rules":
            judged = quality_rules(spark.createDataFrame(rows, docs.schema), keep=tuple(columns)).collect()
            key = lambda r: tuple((x is None, x) for x in r)
            assert stage_rows(docs) == sorted((tuple(r[c] for c in columns) for r in judged if r.kept), key=key)
            assert all(not brute.quality(r.text)[-1] for r in docs.collect())
        if name == "quality_classifier":
            model = fit_quality(spark.createDataFrame(rows, docs.schema), spark.read.parquet(f"{sf_dir}/labels.parquet"))
            score = model.scores([(r[1] or "").encode() for r in rows])
            assert stage_rows(docs) == [r for r, x in zip(rows, score) if x >= 0.3]
        if name == "ngram_jaccard_join":
            numbered = brute.components([(i, r[1]) for i, r in enumerate(rows)])
            groups = {}
            for i, _, c in numbered:
                groups.setdefault(c, []).append(rows[i])
            left = stage_rows(docs)
            assert len(left) == len(groups)
            least = [min(g, key=lambda r: (r[0] is None, r[0] or 0))[0] for g in groups.values()]
            assert sorted(r[0] for r in left) == sorted(least)
        if name == "byte_bpe":
            want = coder()
            assert sorted((r.doc_id, r.n_tokens, list(r.ids)) for r in docs.collect()) == sorted(
                (r[0], len(t), t) for r in rows for t in [want.encode_ordinary(r[1] or "")]
            )
            assert docs.where("not exact").count() == 0


def test_pipeline_keeps_rows_of_one_id_apart(spark):
    texts = [" ".join(f"{a}{i}" for i in range(60)) for a in "abcd"]
    rows = [(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (None, texts[3]), (2, texts[0]), (None, ""), (3, None)]
    docs = spark.createDataFrame([(i, t, "l", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    docs = materialize(docs)
    stages = dict(STAGES)
    key = lambda r: (str(r[0]), r[1] or "")
    got = [(r.doc_id, r.text) for r in stages["ngram_jaccard_join"](spark, docs, "").collect()]
    assert sorted(got, key=key) == sorted([*rows[:4], rows[6], rows[7]], key=key)
    mixed = [(r.doc_id, r.text) for r in stages["mix_sources"](spark, docs, "").collect()]
    assert sorted(mixed, key=key) == sorted(rows[:6], key=key)  # one source: each text with words once
    coded = stages["byte_bpe"](spark, docs, "").collect()
    assert len(coded) == len(rows) and all(r.exact for r in coded)


def test_find_runs_in_small_alphabets():
    rng = random.Random(8)
    texts = [[], [b"a"] * 5, [b"a"] * 6, [b"a"] * 97, [b"a", b"b"] * 4, [b"x"]]
    for size in (1, 2, 3):
        for _ in range(150):
            block = rng.choices([b"a", b"b", b"c"][:size], k=rng.randint(1, 9))
            texts.append(rng.choices(block, k=rng.randint(0, 6)) + block * rng.randint(1, 9) + rng.choices(block, k=rng.randint(0, 30)))
    bounds = np.append(0, np.cumsum([len(t) for t in texts]))
    owner, *spans = find_runs(np.array([hash(w) for t in texts for w in t]), bounds)
    got = [[] for _ in texts]
    for i, *span in zip(owner.tolist(), *(s.tolist() for s in spans)):
        got[i].append(tuple(span))
    assert got == [brute.runs(t)[0] for t in texts]


def test_period_runs(spark):
    df, rows = frame(spark, 9)
    rng = random.Random(9)
    for _ in range(30):
        block = rng.choices(["a", "b", "c", "D"], k=rng.randint(1, 30))
        rows.append((rng.randrange(99), "\n".join(block * rng.randint(1, 7) + ["end"] * rng.randint(0, 8)), "s", "k", "q", "w"))
    df = spark.createDataFrame(rows, KIND)
    got = periodic_runs(df.withColumn("runs", F.lit(1))).collect()
    want = [(r[0], *brute.runs(brute.words(r[1])), len(brute.words(r[1]))) for r in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    found = [(r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got]
    assert sorted(found, key=key) == sorted(((i, n, f, " ".join(k)) for i, f, k, n in want), key=key)
    assert periodic_runs(df.limit(0)).count() == 0


@pytest.mark.parametrize("langs", [1, 3, 70])
def test_merkle_manifest(spark, langs):
    df, rows = frame(spark, 10)
    names = [None, "", "-", "\u00e9", "z"] + [f"l{i}" for i in range(70)]
    rng = random.Random(langs)
    rows = [(r[0], rng.choice(["s", None]), rng.choice(names[:langs]), rng.choice([None, len(r[1] or "")]), r[1], "x") for r in rows * 9]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string, tree string")
    altered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    got = merkle_manifest(df.withColumns({"pos": F.lit(1), "steps": F.lit(2)}), "doc_id", "lang", fields, {"text": altered})
    found = []
    for r in got.collect():
        proof = "".join(s["left"] + s["right"] for s in r.steps)
        found.append((r.id, r.leaf, r.subroot, r.root, brute.hashlib.sha256(proof.encode()).hexdigest(), r.folded_root, r.folded_root == r.root))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(found, key=key) == brute.merkle([r[:5] for r in rows])
    if langs == 1:
        assert merkle_manifest(df.limit(0), "doc_id", "lang", fields).count() == 0
        one = merkle_manifest(df.limit(1), "doc_id", "lang", fields).collect()
        assert len(one) == 1 and one[0].leaf == one[0].root == one[0].folded_root and one[0].steps == []


def test_bk_trees_find_all_near_codes():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40).astype(np.uint64)
    near = base[rng.integers(0, 40, 600)] ^ (np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64))
    codes = np.unique(np.concatenate([base, near, [np.uint64(0), np.uint64(2**64 - 1)]])).view(np.int64)
    shard = np.sort(rng.integers(0, 5, len(codes)))
    trees = BKTrees(codes, shard)
    roots = trees.roots[np.searchsorted(shard[trees.roots], shard)]
    who, at = trees.near(codes, roots, 2)
    gap = np.bitwise_count(codes[:, None] ^ codes[None, :])
    want = {(int(i), int(j)) for i, j in zip(*np.nonzero((gap <= 2) & (shard[:, None] == shard[None, :])))}
    assert set(zip(who.tolist(), at.tolist())) == want and len(who) == len(want)


@pytest.mark.parametrize("most", [3, 40, 4096])
def test_simhash_links_of_hot_shards(spark, most):
    rng = np.random.default_rng(4)
    codes = {0, -1}
    for b in rng.integers(-(2**63), 2**63, 6).tolist():
        for _ in range(60):  # a dense ball, so that shards stay large deal after deal
            flip = 0
            for bit in rng.choice([1, 2, 3, 40, 41, 62, 63], 3).tolist():
                flip ^= 1 << int(bit)
            codes.add(int(np.uint64(b & (2**64 - 1) ^ flip).view(np.int64)))
    codes = sorted(codes)
    found = near_links(spark.createDataFrame([(c,) for c in codes], "fp long"), 2, most).collect()
    up = {c: c for c in codes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in found:
        up[find(a)] = find(b)
    same = {c: find(c) for c in codes}
    plain = np.array(codes).view(np.uint64)
    group = list(range(len(codes)))
    for i, j in zip(*np.nonzero(np.bitwise_count(plain[:, None] ^ plain[None, :]) <= 2)):
        x, y = group[i], group[j]
        if x != y:
            group = [x if g == y else g for g in group]
    assert len(set(same.values())) == len(set(group))
    assert len({(same[c], g) for c, g in zip(codes, group)}) == len(set(group))


def test_simhash(spark):
    df, rows = frame(spark, 11)
    got = simhash_components(df.withColumn("fp", F.lit(1))).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    found = sorted(((r.id, f"{r.fp & (2**64 - 1):016x}", r.component_id) for r in got), key=key)
    assert found == brute.simhash_components([r[:2] for r in rows])
    assert simhash_components(df.limit(0)).count() == 0


def license_spans(text):
    """Detections of one text by plain Python: all matches, less those inside one of an earlier rule."""
    flat = " " + re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", text.lower()).strip() + " "
    found = []
    for place, rule in enumerate(rules()):
        if rule["keyword"] in flat:
            for m in re.finditer(rule["regex"], flat):
                start = flat.count(" ", 0, m.start())
                found.append((start, start + m.group().count(" "), place, rule["label"]))
    inside = lambda d, o: o[2] < d[2] and o[0] <= d[0] and d[1] <= o[1]
    return sorted((d for d in found if not any(inside(d, o) for o in found)), key=lambda d: (d[0], -d[1], d[2]))


def test_license_spans_against_plain_python(spark):
    parts = [
        "licensed under the terms of use", "Creative Commons Attribution-ShareAlike 4.0", "CC BY-SA 4.0 International", "all rights reserved",
        "GNU Lesser General Public License v2.1 or later", "general public license", "GPL v3", "the MIT License", "Apache License, Version 2.0",
        "SPDX-License-Identifier: Apache-2.0", "released into the public domain", "terms of service", "BSD 3-Clause License", "plain words",
        "Permission is hereby granted, free of charge, to any person obtaining a copy", "Copyright (c) 2019", "creative commons zero", "über",
    ]
    rng = random.Random(5)
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 9))) for _ in range(120)]
    texts += [*parts, "", "licensed under the terms of use of the gnu general public license version 3 or any later version", "all rights reserved " * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: r for r in license_scan(df, keep=("id",)).collect()}
    overlapping = 0
    for i, text in enumerate(texts):
        wanted = license_spans(text)
        assert [(d.start, d.end, d.place, d.label) for d in got[i].spans] == wanted, text
        assert set(filter(None, got[i].labels.split(","))) >= {d[3] for d in wanted}
        overlapping += any(a[1] > b[0] for a, b in zip(wanted, wanted[1:]))
    assert overlapping > 20
    assert {d.label for d in got[texts.index("licensed under the terms of use")].spans} == {"licensed", "terms"}

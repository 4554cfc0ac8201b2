"""Token counts, decontamination, licences, toxicity and language model against plain
Python, and their edge cases."""

import collections
import hashlib
import itertools
import math
import re
import textwrap
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF001
from ledgerlake.llm import common, decontaminate, lattice_lm, licenses, token_counts, toxicity

BPE = public_tokenizers.path(token_counts.VOCABULARY)
PIECES = public_tokenizers.path(lattice_lm.VOCABULARY)
DOCS = "doc_id long, text string, n_tokens string, doc string, score double"


def edge(spark):
    """Nulls, empty texts, repeated rows, long texts, columns named like results."""
    rows = [(1, None, "x", None, None), (2, "", None, "y", 1.0), (3, "a b  c\n\n d", "x", "y", 1.0),
            (3, "a b  c\n\n d", "x", "y", 1.0), (None, "You idiot! é😀", None, None, None), (4, "word " * 20000, "", "", 0.0),
            (5, "x" * 30000, "", "", 0.0)]
    return spark.createDataFrame(rows, DOCS)


# -- op6 ---------------------------------------------------------------------

def test_token_counts_equal_the_library(spark):
    t = Tokenizer.from_file(BPE)
    texts = ["", " ", "a", "  a  b\n\n c<|endoftext|> d 's it's\t\tx \n y", "<|endoftext|><|endoftext|>", "日本語。テキスト！" * 9000,
             "abc123,def" * 9000, "a \n b", "ends ", "\n", "x y z  w", "don't  we'll I'M", "1 2  3\n4"]
    texts += [r.text for r in common.table(spark, SF001, "documents").limit(60).collect()]
    want = [len(e) for e in t.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.count_tokens(texts, BPE) == want
    assert all("".join(token_counts.pieces(x)) == x for x in texts)


def test_token_cache_is_bounded_and_exact(monkeypatch):
    texts = [f"word{i} and more {i * i}" for i in range(400)]
    want = token_counts.count_tokens(texts, BPE)
    monkeypatch.setattr(token_counts, "CACHE_PIECES", 50)
    token_counts._caches[BPE].clear()
    got = [n for i in range(0, 400, 37) for n in token_counts.count_tokens(texts[i:i + 37], BPE)]
    assert got == want and len(token_counts._caches[BPE]) <= 50


def test_token_counts_edges(spark):
    got = token_counts.token_counts(edge(spark), BPE, limit=10).collect()
    assert len(got) == 7
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.n_bytes, r.n_tokens, r.over_limit))
    assert by[1] == by[2] == [(0, 0, False)] and len(by[3]) == 2 and by[4][0][2]
    assert token_counts.token_counts(edge(spark).limit(0), BPE).collect() == []


# -- op8 ---------------------------------------------------------------------

def brute_hits(docs, items, w=10):
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    windows = collections.defaultdict(set)
    for i, t in items:
        ws = words(t)
        for k in range(max(1, len(ws) - w + 1) if ws else 0):
            windows[tuple(ws[k:k + w])].add(i)
    out = []
    for i, t in docs:
        ws, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(ws) - n + 1):
                if own := windows.get(tuple(ws[k:k + n])):
                    hit |= set(range(k, k + n))
                    found |= own
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((i, len(ws), len(hit), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 3000])
def test_contamination_equals_brute_force(spark, block_bytes):
    docs, bench = common.table(spark, SF001, "documents"), common.table(spark, SF001, "benchmark")
    got = decontaminate.contamination(docs, bench, block_bytes=block_bytes).collect()
    want = brute_hits([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.items_sha256, r.contaminated) for r in got) == sorted(want)
    assert sum(r.contaminated for r in got) > 10


def test_a_benchmark_of_several_blocks(spark, monkeypatch):
    """No automaton grows beyond a block's characters, whatever the items' sizes; a stretch
    over several blocks is one."""
    rng = np.random.default_rng(9)
    vocabulary = [f"{c}{i}" for i in range(4000) for c in "abé"]
    words = [vocabulary[i] for i in rng.integers(len(vocabulary), size=130_000)]
    items = [(0, " ".join(words[:100_000]))] + [(i, " ".join(words[i * 100:i * 100 + 100])) for i in range(1000, 1300)]
    assert sum(len(t) for _, t in items) > 600_000
    nodes, run = [], decontaminate._pass

    def counted(docs, carry, text_col, block, window):
        nodes.append(decontaminate.build(block, window).get_stats()["nodes_count"])
        return run(docs, carry, text_col, block, window)

    monkeypatch.setattr(decontaminate, "_pass", counted)
    docs = [(1, " ".join(words[:99_000])), (2, "none of it"), (3, " ".join(words[129_950:])), (4, " ".join(words[20_000:20_030]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect())
    assert [(r.doc_id, r.n_words, r.n_hit, r.items_sha256, r.contaminated) for r in got] == sorted(brute_hits(docs, items))
    assert [[(s.start, s.end) for s in r.spans] for r in got] == [[(0, len(docs[0][1]))], [], [(0, len(docs[2][1]))], [(0, len(docs[3][1]))]]
    assert len(nodes) > 2 and max(nodes) <= 256 * 1024 * 10 + 1


def test_contamination_edges_and_offsets(spark):
    items = [(1, "one two three"), (1, "one two three"), (2, None), (3, "!!"), (None, "é x"), (4, "One TWO three")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = ["ONE, two -- three! É x é x", None, "", "one two", "one two three one two three"]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, items string")
    got = sorted(decontaminate.contamination(docs, bench).collect())
    want = sorted(brute_hits(list(enumerate(texts)), items))
    assert [(r.doc_id, r.n_words, r.n_hit, r.items_sha256, r.contaminated) for r in got] == want
    assert [texts[0][s.start:s.end] for s in got[0].spans] == ["ONE, two -- three", "é x"]
    none = decontaminate.decontaminate(docs, bench.limit(0))
    assert none.columns == docs.columns and none.count() == 5
    assert {r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()} == {1, 2, 3}
    assert decontaminate.contamination(docs.limit(0), bench).collect() == []


def test_several_blocks_write_hits_only(spark, monkeypatch):
    """Documents are not written per block; dotted and clashing names and null texts pass."""
    names, write = [], common.written

    def noted(df, name):
        names.append((name, df.columns))
        return write(df, name)

    monkeypatch.setattr(common, "written", noted)
    rows = [(i, " ".join(f"w{k}" for k in range(i, i + 12)) if i % 5 else None, "z", "y") for i in range(300)]
    rows += [(1000 + i, rows[7][1], "z", "y") for i in range(40)]
    docs = spark.createDataFrame(rows, "`a.id` long, `a.text` string, t1 string, hits string")
    items = [(i, " ".join(f"w{k}" for k in range(i * 3, i * 3 + 11))) for i in range(60)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    options = dict(text_col="a.text", block_bytes=60)
    got = decontaminate.contamination(docs, bench, "a.id", **options).collect()
    assert sorted(tuple(r[c] for c in ("a.id", "n_words", "n_hit", "items_sha256", "contaminated")) for r in got) == sorted(
        brute_hits([r[:2] for r in rows], items))
    assert len(names) > 5 and {n for n, _ in names} == {"hits"} and not any("text" in c for _, c in names)
    kept = decontaminate.decontaminate(docs, bench, **options)
    assert kept.columns == docs.columns
    assert sorted(r["a.id"] for r in kept.collect()) == sorted(r["a.id"] for r in got if not r.contaminated)


# -- op1 ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def licence_model(spark):
    return licenses.train(licenses.sample_lines(common.table(spark, SF001, "documents"), "doc_id", "text"))


def test_every_template_is_found_and_confirmed(licence_model):
    for family, notices in licenses.TEMPLATES.items():
        for notice in notices:
            found = licenses.find(f"Some words before.\n{notice}\nand after", licence_model)
            assert [x["family"] for x in found if x["confirmed"]] == [family], notice
            pairs = licenses.pairs(licenses._words(notice))
            stop = sum(all(w in licenses.STOP_WORDS for w in p) for p in pairs)
            assert stop < licenses.CONFIRM * len(pairs)  # no confirmation without an anchor word


#: Texts in which the templates stand with other words in between and after.
CANONICAL = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
           "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met:",
    "GPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
           "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
}


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// ", "REM "])
@pytest.mark.parametrize("width", [40, 60, 70, 80])
def test_wrapped_notices_are_found_and_confirmed(licence_model, mark, width):
    notices = [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts] + list(CANONICAL.items())
    for family, notice in notices:
        lines = [mark + x for x in textwrap.wrap(notice, width)]
        text = "\n".join(["Some words before.", mark.rstrip(), *lines, mark.rstrip(), "and after"])
        confirmed = [x for x in licenses.find(text, licence_model) if x["confirmed"]]
        assert [x["family"] for x in confirmed] == [family], (notice, confirmed)
        assert text.index(lines[0]) == confirmed[0]["start"] and confirmed[0]["end"] <= text.rindex(lines[-1]) + len(lines[-1])


def test_several_notices_in_one_line_or_block(licence_model):
    two = "Licensed under the MIT License. Licensed under the Apache License, Version 2.0."
    for text in (two, f"One more word. {two} And others. " + "foreign words " * 400, two.replace(". L", ".\nL")):
        found = [x for x in licenses.find(text, licence_model) if x["confirmed"]]
        assert sorted(x["family"] for x in found) == ["Apache", "MIT"]
    many = ("Released under the BSD License. " * 3000).strip()
    assert {x["family"] for x in licenses.find(many, licence_model)} == {"BSD"}


def test_other_legal_words_are_unknown(licence_model):
    for text in ("The license plate of the car", "Apache helicopters flew over", "Permission to enter is granted",
                 "A copy of the book in the public library", "", "\n\n"):
        assert not [x for x in licenses.find(text, licence_model) if x["confirmed"]]


def test_corpus_notices_equal_a_plain_search(spark, licence_model):
    docs = common.table(spark, SF001, "documents")
    got = {r.doc_id: sorted(docs_text[r.doc_id][x.start:x.end] for x in r.found if x.confirmed)
           for docs_text in [{r.doc_id: r.text for r in docs.collect()}]
           for r in licenses.scan(docs, licence_model, ["doc_id"]).select("doc.doc_id", "found").collect()}
    for r in docs.collect():
        want = sorted(x for x in (r.text or "").split("\n") if re.search(r"(?i)licen[sc]e|all rights reserved", x))
        assert got[r.doc_id] == want


def test_licence_edges(spark, licence_model):
    got = licenses.scan(edge(spark), licence_model, ["doc_id"]).collect()
    assert len(got) == 7 and all(r.found == [] for r in got)
    assert {r.doc.doc_id: r.n_paragraphs for r in got}[3] == 2
    assert licenses.scan(edge(spark).limit(0), licence_model, ["doc_id"]).collect() == []


def test_a_long_text_without_blank_lines_needs_little_memory(licence_model):
    rows = "".join(f"{i % 7},{i},{i % 3}\n{i} license of {i}\n" for i in range(50_000))
    text = f"Licensed under the MIT License.\n{rows}Released under the BSD License."
    tracemalloc.start()
    found = licenses.find(text, licence_model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [x["family"] for x in found if x["confirmed"]] == ["MIT", "BSD"]
    assert peak < 40 * len(text)


def test_an_id_of_many_texts_keeps_the_sample_bounded(spark):
    docs = spark.range(licenses.SAMPLE_DOCS * 3).select(F.lit(1).alias("doc_id"), F.concat(F.lit("line "), "id").alias("text"))
    assert len(licenses.sample_lines(docs, "doc_id", "text")) == licenses.SAMPLE_DOCS


# -- op3 ---------------------------------------------------------------------

def test_an_id_of_many_texts_keeps_the_toxicity_sample_bounded(spark):
    n = toxicity.SAMPLE_DOCS[1] + 500
    labelled = spark.range(40).select(F.col("id"), (F.col("id") % 2).cast("int").alias("toxic")).where(
        ~toxicity.held_out(F.col("id")))
    hot = labelled.where("toxic = 1").first().id
    texts = spark.range(n).select(F.lit(hot).alias("doc_id"), F.concat(F.lit("bad "), "id").alias("text")).unionByName(
        labelled.select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), "id").alias("text")))
    rows = toxicity.sample(texts, labelled.withColumnRenamed("id", "doc_id"), "doc_id", "text", "toxic")
    assert sum(y for _, y in rows) == toxicity.SAMPLE_DOCS[1]
    assert sum(1 - y for _, y in rows) == labelled.where("toxic = 0").count()
    assert rows == toxicity.sample(texts.repartition(5), labelled.withColumnRenamed("id", "doc_id"), "doc_id", "text", "toxic")


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    lengths, moves = np.array([3, 0, 1, 5, 2]), np.exp(rng.normal(size=(2, 2)))
    logits = rng.normal(size=11) * 2
    p, pairs = toxicity.marginals(logits, lengths, moves)
    at, joint = 0, np.zeros((2, 2))
    for n in lengths:
        total, mine, both = 0.0, np.zeros(n), np.zeros((2, 2))
        for s in itertools.product((0, 1), repeat=int(n)):
            w = math.exp(sum(logits[at + i] * x for i, x in enumerate(s))) * math.prod(moves[a][b] for a, b in zip(s, s[1:]))
            total += w
            mine += w * np.array(s)
            for a, b in zip(s, s[1:]):
                both[a, b] += w
        assert np.allclose(mine / total, p[at:at + n])
        joint += both / total
        at += n
    assert np.allclose(joint, pairs)


def test_toxicity_on_held_out_rows(spark):
    docs, labels = common.table(spark, "/root/testdata/sf0.1", "documents"), common.table(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.fitted(docs, labels)
    scored = toxicity.score(docs, model, ["doc_id", "text"]).select("doc.*", "score", "spans").where(
        toxicity.held_out(F.col("doc_id")))
    rows = scored.join(labels, "doc_id").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows) and len(rows) > 500
    right = collections.Counter((r.toxic, (r.score >= 0.5) == bool(r.toxic)) for r in rows)
    # Some rows are labelled toxic without any toxic word (junk): no model can tell them.
    assert right[1, True] / (right[1, True] + right[1, False]) >= 0.9
    assert right[0, True] / (right[0, True] + right[0, False]) >= 0.98
    spans = collections.Counter(r.text[s.start:s.end].lower() for r in rows if r.toxic for s in r.spans)
    assert spans["idiot"] > 5


def test_toxicity_edges(spark):
    docs = edge(spark)
    none = spark.createDataFrame([(1, 0, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fitted(docs, none)
    assert {r.score for r in toxicity.score(docs, model, ["doc_id"]).collect()} == {1 / (1 + math.exp(30.0))}
    toxic = spark.createDataFrame([(i, 1) for i in range(1, 6)], "doc_id long, toxic int")
    only = toxicity.score(docs, toxicity.fitted(docs, toxic), ["doc_id"]).collect()
    assert len(only) == 7 and all(r.score > 0.99 for r in only)
    assert toxicity.score(docs.limit(0), model, ["doc_id"]).collect() == []
    kept = toxicity.without_toxic(docs, none)
    assert kept.columns == docs.columns and kept.count() == 7


# -- op5 ---------------------------------------------------------------------

def test_lattice_equals_enumeration_of_segmentations():
    pieces = lattice_lm.Pieces.load(PIECES)
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    table = {sp.id_to_piece(i): pieces.log_p[0, i] for i in range(sp.get_piece_size())
             if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)) and "▁" not in sp.id_to_piece(i)[1:]}

    def p(s, first=True):
        if not s:
            return 1.0
        total = sum(math.exp(table[s[:j]]) * p(s[j:], False) for j in range(1, len(s) + 1)
                    if s[:j] in table and (first or s[0] != "▁"))
        if not first:
            total += math.exp(sum(pieces.log_p[0, pieces.byte[b]] for b in s[0].encode())) * p(s[1:], False)
        return total

    words = ["the", "banana", "él", "x▁y", "日本語", "a", "🤖", '"hi,"']
    assert np.allclose(lattice_lm.log_lattice(pieces, words)[0], [math.log(p("▁" + w)) for w in words])
    # Expected counts: every segmentation spells the word, so characters add up.
    used = lattice_lm.expected_counts(pieces, ["banana"], np.array([[2.0]]))[0]
    chars = sum(n * (1 / 1 if sp.is_byte(i) else len(sp.id_to_piece(i))) for i, n in enumerate(used) if n)
    assert abs(chars - 2 * len("▁banana")) < 1e-9
    long = "ab" * 3000
    assert np.isfinite(lattice_lm.log_lattice(pieces, [long])).all()


def test_probabilities_of_words_sum_to_one():
    t = lattice_lm.Totals(np.array([10, 6]), np.array([2, 1]), np.array([3, 1]), 5)
    c = np.array([[4, 3, 1, 1, 1, 0], [0, 2, 0, 0, 4, 0]], dtype=float)
    lattice = np.full((2, 6), 1 / 6)  # as if these were all words
    assert np.allclose(lattice_lm.word_probabilities(c, lattice, t).sum(axis=1) + t.end, 1.0)


def test_document_scores_equal_brute_force(spark):
    docs = common.table(spark, SF001, "documents")
    got = {r.doc_id: r for r in lattice_lm.op5_lattice_lm(spark, SF001).collect()}
    rows = [(r.doc_id, [w for w in re.split("[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")) if w])
            for r in docs.collect()]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    count, ends = collections.Counter(), sum(not h for h in held.values())
    for i, ws in rows:
        if not held[i]:
            count.update(ws)
    n, v = sum(count.values()) + ends, len(count) + 1
    assert len(got) == len(rows)
    for i, ws in rows:
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws) + math.log10((ends + 1) / (n + v + 1))
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws) + 1, sum(count[w] > 0 for w in ws) + 1, n)
        assert abs(r.base_score - base) < 1e-7 * abs(base) and r.score < 0
    unseen = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in unseen) > 1.05 * sum(r.base_score for r in unseen)


def test_rare_and_frequent_words_score_alike(spark, monkeypatch):
    docs = common.table(spark, SF001, "documents").limit(200)
    a = {r.doc_id: r.score for r in lattice_lm.document_scores(docs, PIECES, class_col="lang").collect()}
    monkeypatch.setattr(lattice_lm, "FREQUENT", 20)  # nearly all words by the join
    b = {r.doc_id: r.score for r in lattice_lm.document_scores(docs, PIECES, class_col="lang").collect()}
    assert a.keys() == b.keys() and all(abs(a[i] - b[i]) < 1e-6 * abs(a[i]) for i in a)


def test_document_score_edges(spark):
    got = lattice_lm.document_scores(edge(spark), PIECES).collect()
    assert len(got) == 7 and {r.doc_id: r.n_tokens for r in got}[1] == 1
    three = [r for r in got if r.doc_id == 3]
    assert len(three) == 2 and three[0] == three[1] and all(math.isfinite(r.score) for r in got)
    assert lattice_lm.document_scores(edge(spark).limit(0), PIECES).collect() == []
    nobody = edge(spark).where("doc_id = 5")
    assert lattice_lm.document_scores(nobody.withColumn("doc_id", F.lit(2 if zlib.crc32(b"2") % 7 == 2 else 9)), PIECES).count() == 1

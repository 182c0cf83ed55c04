"""Chat formatting, sharding and licence scans against plain Python."""

import hashlib
import re
import zlib

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import AWKWARD, documents, with_clashes
from llm import chat, licenses, sharding

TURNS = "conv_id bigint, turn bigint, role string, text string"
BITS = st.sampled_from(["<|", "|>", "<", "|", "\\", "\\\\", "<|start|>", "<|end|>\n", "<|text|>", "<|next|>", "</s>", "[INST]", "<<SYS>>", "<<s>", "a", "\n", "é", " ", "\U0001f600"])


def turn_rows(talks):
    return [(c, t, role, text) for c, turns in talks.items() for t, (role, text) in enumerate(turns)]


def expected(turns):
    turns = [(r or "", t or "") for r, t in turns]
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def check_chat(spark, talks):
    df = chat.format_conversations(spark.createDataFrame(turn_rows(talks), TURNS).repartition(3))
    got = {r.conv_id: r for r in chat.digests(df).collect()}
    made = {r.conv_id: r for r in df.collect()}
    assert set(got) == set(talks)
    for c, turns in talks.items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected(turns)
        assert r.formatted_chars == len(made[c].formatted)
        blocks = 1 + sum((a[0] or "") != (b[0] or "") for a, b in zip(turns, turns[1:]))
        assert made[c].formatted.count(chat.START) == made[c].formatted.count(chat.END) == blocks
        assert all(made[c].formatted[s.at - 8:s.at] in (chat.TEXT, chat.NEXT) for s in made[c].loss_spans)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "<|end|>\n"]), st.lists(BITS, max_size=6).map("".join)), min_size=1, max_size=5), min_size=1, max_size=12))
def test_any_conversation_reads_back(spark, talks):
    check_chat(spark, dict(enumerate(talks)))


def test_conversations_with_odd_rows(spark):
    check_chat(spark, {None: [("user", "no id")], 1: [(None, None), ("", "x"), ("assistant", None), ("assistant", "")],
                       2: [("assistant", "long " * 20000)], 3: [("user", "t"), ("assistant", "t")] * 300})


def test_turn_order_ties_and_extra_columns(spark):
    rows = spark.createDataFrame([(1, 2, "user", "c"), (1, 1, "user", "b"), (1, 1, "user", "b"), (1, None, "system", "a")], TURNS)
    df = chat.format_conversations(rows.withColumn("turns", F.lit(1)).withColumn("formatted", F.lit(2)))
    assert df.collect()[0].formatted == "<|start|>system<|text|>a<|end|>\n<|start|>user<|text|>b<|next|>b<|next|>c<|end|>\n"
    assert chat.format_conversations(rows.limit(0)).count() == 0


def jump(key, shards):
    shard = at = step = 0
    while at < shards:
        shard, step = at, step + 1
        # XXH64 of a bigint key (null: the seed alone), then of the step, as Spark chains them
        seed = 42 if key is None else xxhash.xxh64_intdigest(int(key).to_bytes(8, "little", signed=True), seed=42)
        draw = xxhash.xxh64_intdigest(step.to_bytes(4, "little"), seed=seed) >> 33
        at = int(np.floor((at + 1) * 2.0**31 / (draw + 1)))
    return shard


def test_shards_follow_the_law(spark):
    rows = AWKWARD + [(i, f"t{i}") for i in range(100, 3000)]
    for shards in (1, 3, 40, 200):
        got = sharding.shard_documents(with_clashes(documents(spark, rows)).repartition(6), shards).collect()
        assert sorted(((r.doc_id is None, r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(
            ((i is None, i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows), key=str)
        assert all(r.law == "key" and r.shard == jump(r.doc_id, shards) and r.grown_shard == jump(r.doc_id, shards + 1) for r in got)
        assert all(r.grown_shard in (r.shard, shards) for r in got)
        slots = {}
        for r in got:
            slots.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = np.bincount([jump(i, 40) for i in range(20000)], minlength=40)
    assert counts.min() > 400 and counts.max() < 600
    assert sharding.shard_documents(documents(spark, []), 40).count() == 0


def test_write_shards(spark, tmp_path):
    rows = [(i, f"t{i}") for i in range(50)]
    sharding.write_shards(documents(spark, rows), str(tmp_path / "s"), 4)
    got = spark.read.parquet(str(tmp_path / "s")).collect()
    assert sorted((r.doc_id, r.text, r.shard) for r in got) == [(i, t, jump(i, 4)) for i, t in rows]


LICENSED = [
    (1, "Released under the MIT License."), (2, "Licensed under the Apache License, Version 2.0."), (3, "Licensed under CC BY-NC 4.0."),
    (4, "under the mit license under the MIT\nlicense; cc-by-nc"), (5, "This work is licensed under the GNU General Public License, version 3."),
    (6, "the mit license, under"), (7, "cc by cc by nc nc"), (8, "underthe mit license"), (9, "under the émit license"),
    (10, "Permission is hereby granted, free of charge, to anyone who likes"), (11, "x " * 30000 + "cc by nc"),
    (12, "ApAcHe LICENSE version 2 apache license VERSION 20")]


def base_places(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = [(i, p.label) for p in licenses.PHRASES for i in range(len(words)) if words[i:i + len(p.text.split())] == p.text.split()]
    return words, found


def test_licenses(spark):
    rows = LICENSED + [(100 + (i or 0), t) for i, t, *_ in AWKWARD]
    got = licenses.scan_licenses(with_clashes(documents(spark, rows))).collect()
    by_key = {}
    for i, t in rows:
        by_key.setdefault(i, []).append(t)
    assert len(got) == len(rows)
    for r in got:
        words, found = base_places(by_key[r.doc_id][0])
        labels = sorted({x for _, x in found})
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(found), ",".join(labels))
        assert (r.first_word, r.last_word) == (min((i for i, _ in found), default=None), max((i for i, _ in found), default=None))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert not found or r.score > 0.999
    labels = {r.doc_id: r.labels for r in got}
    assert labels[5] == "gpl,gpl-3" and labels[6] == labels[8] == labels[9] == "" and labels[10] == "mit"
    assert labels[7] == "cc-by-nc" and labels[4] == "cc-by-nc,mit" and labels[11] == "cc-by-nc"
    assert licenses.scan_licenses(documents(spark, [])).count() == 0


def test_license_templates_match_in_part(spark):
    text = next(t for t in licenses.TEMPLATES if t.label == "bsd").text
    half = " ".join(text.split()[:10]) + " other words"
    bad_key = text.replace("and use", "or use")
    got = {r.doc_id: r for r in licenses.scan_licenses(documents(spark, [(1, text), (2, half), (3, bad_key), (4, "plain")])).collect()}
    assert got[1].labels == "bsd" and got[1].score > 0.999
    assert got[3].labels == "" and got[3].score == 0
    assert got[2].score < 1


def test_labels_depend_on_the_text_alone(spark):
    """Whatever the other rows make of the words' weights, a key phrase that stands whole gives its label."""
    text = "the terms of the GNU General Public License apply here"
    for others in ("licensed under the version", "gnu general public license", "nothing"):
        rows = [(1, text), *[(i, others) for i in range(2, 200)]]
        assert {r.doc_id: r for r in licenses.scan_licenses(documents(spark, rows)).collect()}[1].labels == "gpl"


def test_whole_licenses(spark):
    """A published text gives its label with a full score, a text of the same words in other places none."""
    wholes = [t for t in licenses.TEMPLATES if len(t.text.split()) > 50]
    assert {t.label for t in wholes} == {"mit", "bsd", "isc", "zlib"}
    rows = [(i, f"Copyright 2020\n{t.text.upper()}\nend") for i, t in enumerate(wholes)]
    rows += [(10 + i, " ".join(reversed(t.text.split()))) for i, t in enumerate(wholes)] + [(20, " ".join(t.text for t in wholes))]
    got = {r.doc_id: r for r in licenses.scan_licenses(documents(spark, rows)).collect()}
    for i, t in enumerate(wholes):
        assert (got[i].labels, got[i].base_labels) == (t.label, "") and got[i].score > 0.999
        assert got[10 + i].labels == "" and got[10 + i].score == 0
    assert got[20].labels == "bsd,isc,mit,zlib"


def test_license_index_holds_the_rarest_places():
    """Both looked-up words are mandatory, rarest first; a phrase of one word stands for both."""
    frequency = {"a": 5, "b": 1, "c": 3, "d": 9}
    *_, rare, looked = licenses.build_index([licenses.phrase("x", "a b c"), licenses.Template("y", "b d a", ("d a",)), licenses.phrase("z", "d d")], 10, frequency)
    assert rare == ["a", "b", "d"] and looked == ["a", "b", "c", "d"]

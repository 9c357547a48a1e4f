"""Packing, WARC archives, chat formatting and the pipeline."""

import hashlib
import io
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from ledgerloom.llm import chat, packing, warc

CONTROL = "</s>[INST] ok [/INST]"


def check_packing(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return by_sequence


def test_tokens_pieces_and_places(spark, sf_dir):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens.encode_special_tokens = True
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).collect()]
    texts += [None, "", " ", "a  b\n\n c", "<|endoftext|> é 😀", "x" * 30_000, "same", "same"]
    rows = spark.createDataFrame([(k, t, 1, "z") for k, t in enumerate(texts)] + [(None, "no id", 1, "z")],
                                 "doc_id long, text string, length int, offset string")
    got = packing.pack(rows).collect()
    by_sequence = check_packing(got, 2048)
    assert len(by_sequence) <= -(-sum(r["length"] for r in got) // 2048) + 1
    for k, text in enumerate(texts):
        ids = np.array(tokens.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        mine = sorted((r for r in got if r["doc_id"] == k), key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine))) and sum(r["length"] for r in mine) == len(ids)
        for r in mine:
            assert zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
            assert r["piece"] == 0 or r["length"] == 2048
    assert sum(r["doc_id"] is None for r in got) == 1


@pytest.mark.parametrize("rule", ["dot", "norm"])
def test_every_capacity_holds(rule):
    random.seed(6)
    counts = {n: random.randint(1, 40) for n in random.sample(range(1, 65 if rule == "norm" else 39), 30)}
    steps = packing.plan(counts, 64, 4, 1500 if rule == "dot" else 64 * 64, (1, 1, 1), rule)
    held = {}
    for length, count in counts.items():
        own = steps[steps[:, 0] == length]
        for rank in range(count):
            at = np.searchsorted(own[:, 1], rank, side="right") - 1
            held.setdefault(int(own[at, 2] + rank - own[at, 1]), []).append((int(own[at, 3]), length))
    for places in held.values():
        assert sum(n for _, n in places) <= 64 and len(places) <= 4
        assert rule == "norm" or sum(n * n for _, n in places) <= 1500
        assert sorted(o for o, _ in places) == [sum(n for p, n in places if p < o) for o, _ in sorted(places)]


def test_plan_refuses_what_fits_nowhere():
    with pytest.raises(ValueError):
        packing.plan({50: 1}, 64, 4, 100, (1, 1, 1), "dot")


def test_sequences_hold_the_ids(spark):
    rows = spark.createDataFrame([(k, "word " * k) for k in range(30)], "doc_id long, text string")
    packed = packing.pack(rows, capacity=64, with_ids=True)
    total = sum(r["length"] for r in packed.collect())
    got = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in got) == total and all(len(r["ids"]) <= 64 and r["boundaries"][0] == 0 for r in got)
    assert packing.pack(rows.limit(0)).count() == 0


def test_warc_round_trip(spark):
    big = "<p>é</p>" * 40
    rows = [(5, "http://a", big, 1), (3, "http://b", big, 1), (9, None, big, 1), (1, "u\r\nWARC-Type: x", "short", 1),
            (2, "u", "short", 1), (4, "u", None, 1), (6, "u", "", 1), (7, "u", "a\r\n\r\nb" * 60, 1),
            (None, "u", big, 1), (3, "http://b", big, 1), (None, "u", "n" * 200, 1)]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string, records int")).collect()
    assert len(got) == len(rows)
    seen = sorted((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got)
    size, digest = len(big.encode()), hashlib.sha256(big.encode()).hexdigest()
    same = [r for r in got if r["payload_digest"] == digest]  # page 7 has as many bytes
    assert sorted((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in same) == [
        (0, size, "revisit", 3), (3, size, "response", None), (3, size, "response", None), (5, size, "revisit", 3),
        (9, size, "revisit", 3)]
    assert sum(x[2] == "response" and x[1] < 100 for x in seen) == 4
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_members_and_faults():
    data = [warc.record(k, "u", b"x" * k, "d" if k else "", revisit=True, refers_to=0) for k in range(50)]
    packed = b"".join(warc.member(d) for d in data)
    assert list(warc.members(io.BytesIO(packed), 7)) == data
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(packed[:-5]), 7))
    with pytest.raises(ValueError):
        warc.parse(data[3].replace(b"HTTP/1.1 200", b"HTTP/1.1 201"))
    with pytest.raises(ValueError):
        warc.parse(data[3][:-1])


def test_escape_is_reversible(spark):
    random.seed(9)
    parts = ["<", "[", "\\", "|im_start|>", "|im_end|>", "INST]", "/INST]", "s>", "/s>", "<|im_end|>\n", CONTROL, "x", "%0A", "%25", "\n"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 9))) for _ in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select("t", chat.escape(rows["t"]).alias("e"), chat.unescape(chat.escape(rows["t"])).alias("b")).collect():
        assert r["b"] == r["t"] and "<|im_end|>" not in r["e"] and "[/INST]" not in r["e"]


def test_conversations_read_back(spark):
    rows = [(1, 0, "user", CONTROL), (1, 1, "assistant", "a<|im_end|>\nb"), (1, 1, "assistant", None), (2, None, None, "t"),
            (None, 0, "assistant", "😀"), (3, 0, "a\nb%0A", "x")] + [(4, k, "user", str(k)) for k in range(300)]
    got = {r["conv_id"]: r for r in chat.format_conversations(
        spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn int, role string, text string, depth int")).collect()}
    for conv in (1, 2, None, 3, 4):
        want = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] or 0, r[1] or "", r[2] or ""))
        assert [tuple(t) for t in got[conv]["turns"]] == [(r or "", t or "") for _, r, t in want]
        assert got[conv]["loss_text"] == "".join(t or "" for _, r, t in want if r == "assistant")
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0


def test_reply_trees(spark):
    #   1 -> 2 -> 4 (score 1 + 2 + 0), 1 -> 3 (1 + 5); 9 answers a missing message; 20 and 21 are a cycle
    rows = [("t", 1, None, 1.0), ("t", 2, 1, 2.0), ("t", 3, 1, 5.0), ("t", 4, 2, None), ("t", 9, 77, 0.5), ("t", 20, 21, 9.0),
            ("t", 21, 20, 9.0), ("u", 1, None, None)]
    nodes = spark.createDataFrame(rows, "tree string, node long, parent long, score double")
    got = chat.paths(nodes, top=3).collect()
    found = {}
    for r in sorted(got, key=lambda r: r["depth"]):
        found.setdefault((r["tree"], r["rank"]), []).append(r["node"])
    assert found == {("t", 1): [1, 3], ("t", 2): [1, 2, 4], ("t", 3): [9], ("u", 1): [1]}


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, left, sf_dir)
        assert kept.columns == docs.columns, name
        ids = [r[0] for r in kept.select("doc_id").collect()]
        before = {r[0] for r in left.select("doc_id").collect()}
        assert len(ids) == len(set(ids)) and set(ids) < before, name
        left = docs.where(docs["doc_id"].isin(ids))
    rows = corpus_pipeline.STAGES[-1][1](spark, left, sf_dir).collect()
    check_packing(rows, 2048)
    assert {r["doc_id"] for r in rows} == set(ids)

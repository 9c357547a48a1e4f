"""Removal of word passages that already occur in an earlier document, confirmed by suffix automata.

A window is ``WINDOW`` consecutive words.  Every word covered by a window that also starts in a document with
a smaller ``doc_id`` is removed.  The corpus is its own reference, so shards of it can't be broadcast with a
size bound; instead each document is led to just the references that share a passage with it:

1. Every window has one anchor, the least hash among its 25-word grams.  Windows of a document with the same
   anchor form a run, so a corpus of n words has about n / 13 runs, not n windows.
2. Runs whose anchor occurs in one document only are dropped.  A run whose content occurs in a smaller
   document gets that document as reference; other runs are resolved window by window.
3. For each reference a suffix automaton of its words is built (rows arrive sorted by reference), the spans of
   later documents stream through it, and windows whose matching statistic reaches ``WINDOW`` are confirmed
   word by word.
4. The confirmed spans are cut out of each document.

Steps 1 and 2 are hashes of 64 bits and only route; step 3 decides on words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import id_and_bytes, map_batches, mix, signed, sliding_minimum, window_hashes, word_ids
from ledgerloom.scale import durable

WINDOW = 50
GRAM = 25


class SuffixAutomaton:
    """All substrings of a word list; ``matches`` streams another list and gives the matching statistics."""

    def __init__(self, words: list) -> None:
        self.step: list[dict] = [{}]
        self.link = [-1]
        self.size = [0]
        last = 0
        for word in words:
            last = self._add(word, last)

    def _state(self, step: dict, link: int, size: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _add(self, word, last: int) -> int:
        step, link, size = self.step, self.link, self.size
        new = self._state({}, 0, size[last] + 1)
        at = last
        while at >= 0 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at >= 0:
            after = step[at][word]
            if size[after] == size[at] + 1:
                link[new] = after
            else:
                split = self._state(dict(step[after]), link[after], size[at] + 1)
                while at >= 0 and step[at].get(word) == after:
                    step[at][word] = split
                    at = link[at]
                link[after] = link[new] = split
        return new

    def matches(self, words: list):
        """Length of the longest suffix of the words read so far that is a substring, after each word."""
        state, length = 0, 0
        step, link, size = self.step, self.link, self.size
        for word in words:
            while state and word not in step[state]:
                state = link[state]
                length = size[state]
            if word in step[state]:
                state = step[state][word]
                length += 1
            yield length


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans, sorted."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _runs(window: int, gram: int):
    def run(batch: pa.RecordBatch) -> dict:
        columns: dict[str, list] = {"anchor": [], "content": [], "doc_id": [], "row": [], "first": [], "last": []}
        triples = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "text")), strict=True)
        for doc, row, text in triples:
            words = text.split()
            if len(words) < window or doc is None:
                continue
            ids = word_ids(words)
            anchors = sliding_minimum(window_hashes(ids, gram), window - gram + 1)
            whole = window_hashes(ids, window)
            cut = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
            first = np.concatenate(([0], cut))
            last = np.concatenate((cut - 1, [len(anchors) - 1]))
            # Both end windows tell the content of a run only while they overlap, so longer runs are split.
            if (last - first).max() >= window:
                pieces = [(s, min(s + window - 1, e)) for a, e in zip(first, last, strict=True)
                          for s in range(a, e + 1, window)]
                first, last = (np.array(x) for x in zip(*pieces, strict=True))
            content = mix(whole[first] * np.uint64(3) + mix(whole[last] + (last - first).astype(np.uint64)))
            columns["anchor"].append(signed(anchors[first]))
            columns["content"].append(signed(content))
            columns["first"].append(first)
            columns["last"].append(last)
            columns["doc_id"].append(np.full(len(first), doc))
            columns["row"].append(np.full(len(first), row))
        return {k: np.concatenate(v) for k, v in columns.items()} if columns["doc_id"] else None

    return run


def _windows(window: int):
    def run(batch: pa.RecordBatch) -> dict | None:
        hashes, starts, docs, rows = [], [], [], []
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "row", "text", "runs"))
        for doc, row, text, runs in zip(*columns, strict=True):
            at = [np.arange(r["first"], r["last"] + 1) for r in runs if r["ref"] is None]
            if not at:
                continue
            at = np.unique(np.concatenate(at))
            hashes.append(signed(window_hashes(word_ids(text.split()), window)[at]))
            starts.append(at)
            docs.append(np.full(len(at), doc))
            rows.append(np.full(len(at), row))
        if not docs:
            return None
        named = {"hash": hashes, "first": starts, "doc_id": docs, "row": rows}
        return {k: np.concatenate(v) for k, v in named.items()}

    return run


def _streams(window: int):
    """The words of each document's spans, one row per reference."""

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"ref": [], "doc_id": [], "row": [], "spans": []}
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "row", "text", "runs"))
        for doc, row, text, runs in zip(*columns, strict=True):
            words, by_ref = text.split(), {}
            for r in runs:
                by_ref.setdefault(r["ref"], []).append((r["first"], r["last"] + window))
            for ref, spans in by_ref.items():
                out["ref"].append(ref)
                out["doc_id"].append(doc)
                out["row"].append(row)
                out["spans"].append([{"start": s, "words": b" ".join(words[s:e])} for s, e in merged(spans)])
        return out

    return run


def _confirm(window: int):
    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"doc_id": [], "row": [], "confirmed": []}
        held, automaton = None, None
        columns = (batch.column(c).to_pylist() for c in ("ref", "doc_id", "row", "spans", "ref_text"))
        for ref, doc, row, spans, text in zip(*columns, strict=True):
            if automaton is None or held != (ref, text):
                held, automaton = (ref, text), SuffixAutomaton(text.split())
            found = []
            for span in spans:
                for at, length in enumerate(automaton.matches(span["words"].split())):
                    if length >= window:
                        end = span["start"] + at + 1
                        if found and end - window <= found[-1]["end"]:
                            found[-1]["end"] = end
                        else:
                            found.append({"start": end - window, "end": end})
            if found:
                out["doc_id"].append(doc)
                out["row"].append(row)
                out["confirmed"].append(found)
        return out

    return run


def _cut(batch: pa.RecordBatch) -> dict:
    out: dict[str, list] = {
        "doc_id": [], "n_words": [], "n_removed": [], "removed": [], "kept_text": [], "kept_sha256": []
    }
    for doc, text, lists in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "lists")), strict=True):
        words = text.split()
        spans = merged([(s["start"], s["end"]) for found in lists or () for s in found])
        keep = np.ones(len(words), dtype=bool)
        for start, end in spans:
            keep[start:end] = False
        kept = words if not spans else [w for w, k in zip(words, keep, strict=True) if k]
        out["doc_id"].append(doc)
        out["n_words"].append(len(words))
        out["n_removed"].append(len(words) - len(kept))
        out["removed"].append([{"start": s, "end": e} for s, e in spans])
        joined = b" ".join(kept)
        out["kept_text"].append(joined)
        out["kept_sha256"].append(hashlib.sha256(joined).hexdigest())
    return out


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, row, text, lists``: every document with its confirmed spans of words (lists of lists).

    ``row`` tells apart rows that repeat a ``doc_id`` with another text.
    """
    texts = id_and_bytes(docs).withColumn("row", F.xxhash64("doc_id", "text"))
    runs = durable(
        map_batches(texts, "anchor long, content long, doc_id long, row long, first int, last int", _runs(window, gram))
    )
    anchors = runs.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = durable(runs.join(anchors.where("low != high").select("anchor"), "anchor"))

    contents = shared.groupBy("anchor", "content").agg(F.min("doc_id").alias("ref"))
    kinds = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
    # A document whose runs are all first occurrences is kept too: others refer to it.
    known = shared.join(contents, ["anchor", "content"]).join(kinds, "anchor").select(
        "doc_id", "row", "first", "last", F.expr("if(ref < doc_id, ref, null)").alias("ref"), "kinds"
    )
    open_runs = F.when(
        F.col("ref").isNotNull() | (F.col("kinds") > 1), F.struct("first", "last", "ref")
    )
    per_doc = known.groupBy("doc_id", "row").agg(F.collect_set(open_runs).alias("runs"))
    affected = durable(texts.join(per_doc, ["doc_id", "row"]))

    windows = durable(map_batches(affected, "hash long, first int, doc_id long, row long", _windows(window)))
    least = windows.groupBy("hash").agg(F.min("doc_id").alias("ref"), F.max("doc_id").alias("high"))
    late = windows.join(least.where("ref != high").select("hash", "ref"), "hash").where("ref < doc_id")
    late = late.groupBy("doc_id", "row").agg(
        F.collect_set(F.struct("first", F.col("first").alias("last"), "ref")).alias("late")
    )
    routed = affected.join(late, ["doc_id", "row"], "left").select(
        "doc_id", "row", "text",
        F.concat(
            F.filter("runs", lambda r: r["ref"].isNotNull()),
            F.coalesce("late", F.array().cast("array<struct<first:int,last:int,ref:bigint>>")),
        ).alias("runs"),
    ).where(F.size("runs") > 0)
    streams = durable(
        map_batches(
            routed, "ref long, doc_id long, row long, spans array<struct<start:int,words:binary>>", _streams(window)
        )
    )
    wanted = streams.select("ref").distinct()
    references = affected.select(F.col("doc_id").alias("ref"), F.col("text").alias("ref_text")).distinct()
    references = references.join(wanted, "ref", "left_semi")
    confirmed = map_batches(
        streams.join(references, "ref"),
        "doc_id long, row long, confirmed array<struct<start:int,end:int>>", _confirm(window),
    )
    lists = durable(confirmed).groupBy("doc_id", "row").agg(F.collect_list("confirmed").alias("lists"))
    return texts.join(lists, ["doc_id", "row"], "left")


def remove_repeated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, removed, kept_sha256`` and, if wanted, ``kept_text`` per row of ``docs``.

    Words are separated by space and tab to carriage return only and are compared unchanged.  Null or blank
    texts have no words.  Windows are judged on the input and within one document nothing is repeated.  Rows
    that repeat a ``doc_id`` don't count as earlier documents for each other; a row without ``doc_id`` neither
    loses words nor counts as earlier.  Other columns are ignored; an empty table gives no rows.
    """
    spans = repeated_spans(docs, window, gram)
    schema = "doc_id long, n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept_sha256 string"
    if not with_text:
        return map_batches(spans, schema, _cut)
    cut = map_batches(spans, f"{schema}, kept_text binary", _cut)
    return cut.withColumn("kept_text", F.col("kept_text").cast("string"))

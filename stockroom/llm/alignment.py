"""Operator 13: alignment of two tokenizers' tokens, as an Arrow pipeline.

Method.  Every text (with one space in front) is encoded by tokenizer A
(byte-level BPE) and tokenizer B (BPE with byte fallback).  Per group of
documents the ids are Arrow lists: flattening and parent indices give one
row a token, cumulative sums of the byte lengths less the sum before the
document give its end, and an Acero hash join on (document, end) gives the
places where both tokenizers end.  They cut the tokens into groups.  The
distinct ids of a group, with their counts, meet in a second hash join; a
``Table.group_by`` on (document, pair) then gives a document's links and how
often it holds each.  Products of large groups are made in slices of
``SLICE`` rows.  How many documents hold a pair is counted with
``Table.group_by`` in each task and summed by Spark.

Encoding.  Neither tokenizer joins anything across a change from other
characters to ASCII white space (checked for B's pieces when it is opened;
texts with white space that one of its pieces joins, or with white space
beyond ASCII, are encoded whole), so each distinct
chunk is encoded once per worker (at most ``CACHE`` are kept) and a
document's ids are taken from the chunks' lists.

Counts back to the documents.  The ``COMMON`` most frequent pairs go to all
tasks (a fixed bound, about 5 MB); what is left is joined by shuffle, so the
result never depends on the bound and no pair of the shuffle is hot.

Defined cases.  Texts that are null or empty, or whose tokens of either side
do not give the bytes of space + text again, have no tokens: zeros and an
empty ``groups``.  Rows are told apart by their place, so null and repeated
``doc_id`` stay rows of their own and count as documents of their own.  An
empty table gives no rows.  Other columns are not looked at.  Memory follows
the longest text and the distinct pairs of one document.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.llm.kernels import groups, stash, text_column

CACHE = 150_000            # chunks kept by a worker
CACHE_BYTES = 12 << 20     # and their bytes
GROUP_BYTES = 1 << 19      # texts that go through the pipeline at once
COMMON = 1 << 18           # pairs sent to all tasks
SLICE = 1 << 21            # rows of a product made at once
FLUSH = 1 << 20            # partial counts a task holds
SHIFT = 20                 # a pair is (A id << SHIFT) + B id

# The fixed word pattern of byte-level pre-tokenization.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CHUNK = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
# White space beyond ASCII, in UTF-8, and characters that some tables count as white space.
WIDE_SPACE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1(?:\x9a\x80|\xa0\x8e)|\xe2(?:\x80[\x80-\x8b\xa8\xa9\xaf]|\x81\x9f)"
                        rb"|\xe3\x80\x80|\xef\xbb\xbf")

ALIGNED = T.StructType([
    T.StructField("rid", T.LongType()), T.StructField("doc_id", T.LongType()),
    T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()),
    T.StructField("n_groups", T.LongType()), T.StructField("n_links", T.LongType()),
    T.StructField("groups", T.StringType()),
    T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType())),
])


def byte_level_bytes() -> dict[str, int]:
    """The character that byte-level BPE writes for each byte, by its public
    rule: printable Latin-1 stands for itself, the rest follows from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    """Tokenizer A and the bytes of its entries.

    If the file's merges make its entries in the order of their ids, as they
    do in a byte-level BPE trained from 256 bytes, the ids are ranks, and the
    faster library for ranks gives the same ids; else the file's own library
    encodes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        to_byte = byte_level_bytes()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.piece = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in to_byte for c in token):
                self.piece[i] = bytes(to_byte[c] for c in token)
        self.ranks = self._by_rank(json.loads(Path(path).read_text()), to_byte)
        if self.ranks is not None:
            self.tokenizer = None

    @staticmethod
    def _by_rank(spec: dict, to_byte: dict[str, int]):
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        plain = (spec["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex")
                 and not before.get("add_prefix_space") and model["type"] == "BPE" and not model.get("ignore_merges")
                 and not model.get("unk_token") and not model.get("dropout")
                 and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"))
        if not plain:
            return None
        vocab = model["vocab"]
        made = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        if made != list(range(256, 256 + len(made))) or not {vocab.get(c) for c in to_byte} == set(range(256)):
            return None
        import tiktoken
        added = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(to_byte[c] for c in t): i for t, i in vocab.items() if t not in added}
        return tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, chunks: list[str]) -> list[list[int]]:
        if self.ranks is not None:
            return [*map(self.ranks.encode_ordinary, chunks)]
        return [e.ids for e in self.tokenizer.encode_batch(chunks, add_special_tokens=False)]


class PieceBpe:
    """Tokenizer B, which puts a space in front, and the bytes of its pieces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.space = self.model.piece_to_id("▁")
        self.piece = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode()
                      for i, n in enumerate(names)]
        # white space that no piece has behind another character can begin a chunk
        joined = {c for i, n in enumerate(names) if not self.model.is_byte(i) for c in n.lstrip("▁")[1:] + n[n.startswith("▁"):]}
        self.tied = "".join(c for c in "\t\n\x0b\x0c\r" if c in joined)
        self.cuts = not any("▁" in n.lstrip("▁") for i, n in enumerate(names) if not self.model.is_byte(i))

    def encode(self, chunks: list[str]) -> list[list[int]]:
        # the model puts no space in front of nothing
        got = self.model.encode([c[1:] if c[:1] == " " else c for c in chunks], num_threads=1)
        return [[self.space] if c == " " else ids if c[:1] == " " else ids[1:] if ids[:1] == [self.space] else []
                for c, ids in zip(chunks, got)]


class Lists:
    """Lists of ids that grow, as one Arrow list array."""

    def __init__(self):
        self.values, self.ends = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64)
        self.n = 0                                   # lists; ends[n] values

    def extend(self, lists: list[list[int]]) -> None:
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        used = int(self.ends[self.n])
        more = int(size.sum())
        while used + more > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        while self.n + len(lists) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.values[used:used + more] = np.fromiter(chain.from_iterable(lists), np.int32, more)
        self.ends[self.n + 1:self.n + 1 + len(lists)] = used + np.cumsum(size)
        self.n += len(lists)

    def take(self, which: np.ndarray) -> pa.LargeListArray:
        return pa.LargeListArray.from_arrays(pa.array(self.ends[:self.n + 1]),
                                             pa.array(self.values[:self.ends[self.n]])).take(pa.array(which))


class Encoders:
    """Both tokenizers over distinct chunks."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteBpe(path_a), PieceBpe(path_b)
        self.length_a, self.length_b = (pa.array([len(p) for p in x.piece], pa.int64()) for x in (self.a, self.b))
        tied = b"[" + re.escape(self.b.tied).encode() + b"]|" if self.b.tied else b""
        self.odd = re.compile(tied + WIDE_SPACE.pattern)
        self.name_a, self.name_b = (pa.array([str(i) for i in range(len(x.piece))]) for x in (self.a, self.b))
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.bytes = 0
        self.lists_a, self.lists_b, self.fits = Lists(), Lists(), np.zeros(0, bool)

    def chunks(self, text: bytes) -> list[bytes]:
        whole = not self.b.cuts or self.odd.search(text)
        return [b" " + text] if whole else CHUNK.findall(b" " + text)

    def learn(self, chunks: list[bytes]) -> np.ndarray:
        """Places of the chunks in the lists."""
        if len(self.place) > CACHE or self.bytes > CACHE_BYTES:
            self.clear()
        if new := list(dict.fromkeys(c for c in chunks if c not in self.place)):
            texts = [c.decode("utf-8", "replace") for c in new]
            got_a, got_b = self.a.encode(texts), self.b.encode(texts)
            join, of_a, of_b = b"".join, self.a.piece.__getitem__, self.b.piece.__getitem__
            fits = [join(map(of_a, a)) == c == join(map(of_b, b)) for c, a, b in zip(new, got_a, got_b)]
            self.lists_a.extend(got_a)
            self.lists_b.extend(got_b)
            self.fits = np.concatenate([self.fits, fits])
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.bytes += sum(map(len, new))
        return np.fromiter(map(self.place.__getitem__, chunks), np.int64, len(chunks))


@lru_cache(1)
def _encoders(path_a: str, path_b: str) -> Encoders:
    """One for a worker process, which runs many tasks."""
    return Encoders(path_a, path_b)


def count_by(table: pa.Table, keys: list[str]) -> pa.Table:
    """The distinct keys with ``n``, how many rows hold them."""
    got = table.group_by(keys, use_threads=False).aggregate([([], "count_all")])
    return got.rename_columns([*keys, "n"])


def tokens_of(lists: pa.LargeListArray, chunk_doc: pa.Array, length: pa.Array, base: pa.Array) -> pa.Table:
    """One row a token: id, document, end in the document's bytes, place."""
    ids = lists.flatten()
    doc = chunk_doc.take(pc.list_parent_indices(lists))
    end = pc.subtract(pc.cumulative_sum(length.take(ids)), base.take(doc))
    return pa.table({"id": ids, "doc": doc, "end": end, "at": pa.array(np.arange(len(ids)))})


def cut_groups(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of the groups: places behind their last token in a and in b, and
    the group's document."""
    both = a.select(["doc", "end", "at"]).join(b.select(["doc", "end", "at"]), ["doc", "end"], join_type="inner",
                                               right_suffix="_b", use_threads=False)
    at_a, at_b = both["at"].to_numpy(), both["at_b"].to_numpy()
    order = np.argsort(at_a)
    return at_a[order] + 1, at_b[order] + 1, both["doc"].to_numpy()[order]


def group_text(names: pa.Array, ids: pa.ChunkedArray, ends: np.ndarray) -> pa.Array:
    """The ids of each group, joined by commas."""
    off = pa.array(np.concatenate([[0], ends]))
    return pc.binary_join(pa.LargeListArray.from_arrays(off, names.take(ids.combine_chunks())), ",")


def of_groups(ids: pa.ChunkedArray, ends: np.ndarray) -> pa.Table:
    """Distinct ids of each group with their counts, by group."""
    g = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
    return count_by(pa.table({"g": g, "id": ids}), ["g", "id"]).sort_by("g")


def links_of(a: pa.Table, b: pa.Table, group_doc: np.ndarray) -> pa.Table:
    """(doc, pair, n): the links of each document with their occurrences."""
    per_group = np.bincount(b["g"].to_numpy(), minlength=len(group_doc))
    made = np.cumsum(per_group[a["g"].to_numpy()])
    cuts = [0]
    while cuts[-1] < a.num_rows:
        done = made[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(made, done + SLICE, "right"))))
    docs, parts = pa.array(group_doc), []
    first_b = np.searchsorted(b["g"].to_numpy(), np.arange(len(group_doc) + 1))
    for lo, hi in zip(cuts, cuts[1:]):
        left = a.slice(lo, hi - lo)
        g = left["g"].to_numpy()
        right = b.slice(int(first_b[g[0]]), int(first_b[g[-1] + 1] - first_b[g[0]]))
        both = left.join(right, "g", join_type="inner", right_suffix="_b", use_threads=False)
        pair = pc.add(pc.shift_left(both["id"].cast(pa.int64()), SHIFT), both["id_b"].cast(pa.int64()))
        rows = pa.table({"doc": docs.take(both["g"].combine_chunks()), "pair": pair, "n": pc.multiply(both["n"], both["n_b"])})
        parts.append(_sum_links(rows))
    if not parts:
        return pa.table({"doc": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    return parts[0] if len(parts) == 1 else _sum_links(pa.concat_tables(parts))


def _sum_links(rows: pa.Table) -> pa.Table:
    got = rows.group_by(["doc", "pair"], use_threads=False).aggregate([("n", "sum")])
    return got.rename_columns(["doc", "pair", "n"])


def _align(path_a: str, path_b: str):
    def group(enc: Encoders, texts: list[bytes]):
        split = [enc.chunks(t) if t else [] for t in texts]
        size = np.fromiter(map(len, split), np.int64, len(texts))
        place = enc.learn([c for x in split for c in x])
        doc = np.repeat(np.arange(len(texts)), size)
        good = np.ones(len(texts), bool)
        good[doc[~enc.fits[place]]] = False
        place, doc = place[good[doc]], doc[good[doc]]
        length = np.array([len(t) + 1 if t and ok else 0 for t, ok in zip(texts, good)], np.int64)
        base = pa.array(np.cumsum(length) - length)
        chunk_doc = pa.array(doc)
        a = tokens_of(enc.lists_a.take(place), chunk_doc, enc.length_a, base)
        b = tokens_of(enc.lists_b.take(place), chunk_doc, enc.length_b, base)
        ends_a, ends_b, group_doc = cut_groups(a, b)
        both = pc.binary_join_element_wise(group_text(enc.name_a, a["id"], ends_a), group_text(enc.name_b, b["id"], ends_b), "|")
        n = len(texts)
        n_groups = np.bincount(group_doc, minlength=n)
        text = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_groups)])), both), ";")
        links = links_of(of_groups(a["id"], ends_a), of_groups(b["id"], ends_b), group_doc)
        of = links["doc"].to_numpy()
        order = np.argsort(of, kind="stable")
        off = pa.array(np.searchsorted(of[order], np.arange(n + 1)).astype(np.int32))
        times = links["n"].to_numpy()[order]
        n_links = np.bincount(of[order], weights=times, minlength=n).astype(np.int64)
        return [pa.array(np.bincount(a["doc"].to_numpy(), minlength=n)), pa.array(np.bincount(b["doc"].to_numpy(), minlength=n)),
                pa.array(n_groups), pa.array(n_links), text.cast(pa.string()),
                pa.ListArray.from_arrays(off, pa.array(links["pair"].to_numpy()[order])),
                pa.ListArray.from_arrays(off, pa.array(times))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoders(path_a, path_b)
        for batch in batches:
            off, data = text_column(batch, "text")
            for d, e in groups(off, GROUP_BYTES):
                raw = data[off[d]:off[e]].tobytes()
                at = (off[d:e + 1] - off[d]).tolist()
                cols = group(enc, [raw[x:y] for x, y in zip(at, at[1:])])
                yield pa.RecordBatch.from_arrays([batch.column(0)[d:e], batch.column(1)[d:e], *cols], names=ALIGNED.fieldNames())
    return run


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): rid (its place), doc_id, n_a, n_b,
    n_groups, n_links, groups (``a1,a2|b1;...``), and its links: pairs (A id
    << SHIFT + B id) and times (occurrences of each)."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_align(path_a, path_b), ALIGNED)


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task, each pair once a document."""
    held, rows = [], 0

    def merged() -> pa.Table:
        got = pa.concat_tables(held).group_by("pair", use_threads=False).aggregate([("n", "sum")])
        return got.rename_columns(["pair", "n"])
    for batch in batches:
        held.append(count_by(pa.table({"pair": batch.column(0).flatten()}), ["pair"]))
        rows += held[-1].num_rows
        if rows > FLUSH:
            held, before = [merged()], rows
            rows = held[0].num_rows
            if rows > FLUSH // 2:
                yield from held[0].combine_chunks().to_batches()
                held, rows = [], 0
    if held:
        yield from merged().combine_chunks().to_batches()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a, n, best): in how many documents a pair is linked, and
    whether that is the highest count of its A id."""
    counts = stash(aligned.select("pairs").mapInArrow(_count_pairs, "pair long, n long")
                   .groupBy("pair").agg(F.sum("n").alias("n"))
                   .withColumn("a", F.shiftright("pair", SHIFT)), "pair-counts")
    # one row for each entry of A's vocabulary at most
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), "a").select("pair", "a", "n", (F.col("n") == F.col("most")).alias("best"))


SCORED = "rid long, n_best long, count_sum long, pairs array<long>, times array<long>"


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        known = pa.array(pair)
        for batch in batches:
            lists, times = batch.column(1), batch.column(2).flatten().to_numpy()
            row = pc.list_parent_indices(lists).to_numpy()
            pairs = lists.flatten()
            at = pc.index_in(pairs, value_set=known)
            found = at.is_valid().to_numpy(zero_copy_only=False)
            at = at.fill_null(0).to_numpy()
            rows = batch.num_rows
            sums, bests = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            if len(pair):
                np.add.at(sums, row, np.where(found, n[at] * times, 0))
                np.add.at(bests, row, np.where(found & best[at], times, 0))
            off = pa.array(np.searchsorted(row[~found], np.arange(rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bests), pa.array(sums),
                 pa.ListArray.from_arrays(off, pa.array(pairs.to_numpy()[~found])),
                 pa.ListArray.from_arrays(off, pa.array(times[~found]))], names=["rid", "n_best", "count_sum", "pairs", "times"])
    return run


def score_links(aligned: DataFrame, common: int = COMMON) -> DataFrame:
    """(rid, n_best, count_sum) of every row of ``aligned`` (read more than
    once: a stash or a table): links whose count is the highest of their A
    id, and the sum of the counts over links."""
    counts = pair_counts(aligned)
    most = counts.orderBy(F.col("n").desc(), "pair").limit(common).select("pair", "n", "best").toArrow()
    shared = aligned.sparkSession.sparkContext.broadcast(
        (most["pair"].to_numpy(), most["n"].to_numpy(), most["best"].to_numpy()))
    first = aligned.select("rid", "pairs", "times").mapInArrow(_score(shared), SCORED)
    zipped: Column = F.arrays_zip("pairs", "times")
    rest = first.select("rid", F.explode(zipped).alias("x")).select("rid", F.col("x.pairs").alias("pair"), F.col("x.times").alias("t"))
    rare = rest.join(counts.select("pair", "n", "best"), "pair").select(
        "rid", F.when(F.col("best"), F.col("t")).otherwise(0).alias("n_best"), (F.col("n") * F.col("t")).alias("count_sum"))
    return (first.select("rid", "n_best", "count_sum").unionByName(rare)
            .groupBy("rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))

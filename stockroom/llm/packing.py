"""Operator 1: packing documents into sequences by a grouping genetic algorithm.

Method.  Documents become token ids (plus one end id 0); only longer ones
than ``CAPACITY`` are cut.  A piece of full length is a sequence of its own.
The others are dealt by hash into groups of about ``GROUP`` pieces; several
*islands* (tasks) evolve packings of one group from different seeds.  A
chromosome is a list of bins.  Crossover injects whole well-filled bins of
one parent into the other, removes the bins that hold a duplicate of an
injected piece, and best-fits the displaced pieces; mutation dissolves the
least filled bins the same way.  After each epoch the best packings of an
island migrate to the next island of its group (a shuffle), and the best
packing of all islands stands at the end.  Bins filled below ``WELL`` are
then dissolved and their pieces evolve again in fewer, joint groups, until
one group is left, so group borders cost next to nothing.

Tokens: text is split at ASCII white space, which the tokenizer drops and
never crosses; each distinct chunk is encoded once per worker (``CACHE`` chunks at
most are kept) and ids are joined as bytes.

Defined cases.  Null and empty texts are the one end id.  Rows are told apart
by their place, so null and repeated ``doc_id`` pack as rows of their own.
An empty table gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import random
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.llm.kernels import stash

CAPACITY = 2048
END_ID = 0
GROUP = 2000           # pieces of a group, on average
ISLANDS = 2            # per group
EPOCHS = 2
GENERATIONS = 6        # per epoch
POPULATION = 4
WELL = 0.995           # of CAPACITY; bins below are evolved again
CACHE = 1_200_000

PIECES = T.StructType([
    T.StructField("rid", T.LongType()), T.StructField("doc_id", T.LongType()),
    T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
])


MARKS = b".,;:!?*%&$#)"
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
# the tokenizer's character of each byte: itself, or the next one from 256 on
LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in SHOWN)}


class Chunks(dict):
    """Ids of whole chunks, learnt when first asked for."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, chunk: bytes) -> bytes:
        return self.learn(chunk)


class ChunkEncoder:
    """Little-endian 32-bit ids of texts, with a cache of chunks.

    A chunk of letters, with or without a run of ``MARKS`` behind, is one word
    to the tokenizer (and one run of punctuation), so the merge model alone
    encodes it; any other chunk takes the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.cache = Chunks(self.learn)
        self.words: dict[bytes, bytes] = {}        # words by the merge model; a whole chunk may be none
        self.marks: dict[bytes, bytes] = {b"": b""}  # runs behind words

    def _whole(self, chunk: bytes) -> bytes:
        ids = self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _word(self, word: str) -> bytes | None:
        if word.isascii():
            if not (word.isalpha() and word.islower()):
                return None
        elif not (word.isalpha() and word == word.lower() and unicodedata.is_normalized("NFC", word)):
            return None
        else:
            word = word.encode().decode("latin-1").translate(LEVEL)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def learn(self, chunk: bytes) -> bytes:
        if len(self.cache) + len(self.words) + len(self.marks) > CACHE:
            self.cache.clear()
            self.words.clear()
            self.marks = {b"": b""}
        core = chunk.rstrip(MARKS)
        ids = None
        if core:
            tail = chunk[len(core):]
            low = core.lower()
            if not low.isascii() and (word := low.decode()) and max(word) <= "\xff":
                low = word.lower().encode()         # one letter for one
            ids = self.words.get(low)
            if ids is None and (ids := self._word(low.decode())) is not None and low != chunk:
                self.words[low] = ids
            if ids is not None:
                if tail not in self.marks:
                    self.marks[tail] = self._whole(tail)
                ids += self.marks[tail]
        if ids is None:
            ids = self._whole(chunk)
        self.cache[chunk] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.cache.__getitem__, text.split()))


@lru_cache(1)
def _encoder(path: str) -> ChunkEncoder:
    """One for a worker process, which runs many tasks."""
    return ChunkEncoder(path)


def _tokenize(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder(path)
        end = END_ID.to_bytes(4, "little")
        width = 4 * CAPACITY
        for batch in batches:
            cols: list[list] = [[] for _ in PIECES.fields]
            for rid, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = text.as_py()
                ids = encoder.encode(raw.encode() if raw else b"") + end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    for col, v in zip(cols, (rid, doc, k, at // 4, len(part) // 4, zlib.crc32(part))):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if f.name == "piece" else pa.int64()) for c, f in zip(cols, PIECES.fields)],
                names=PIECES.fieldNames())
    return run


def token_pieces(docs: DataFrame, path: str) -> DataFrame:
    """Pieces of at most CAPACITY ids of every row's text."""
    return docs.select(F.monotonically_increasing_id().alias("rid"),
                       F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(_tokenize(path), PIECES)


# -- one island ------------------------------------------------------------

def best_fit(items: list[int], size: list[int], bins: list[list[int]], room: list[int]) -> None:
    """Put items, largest first, where they leave least room (in place)."""
    by_room: dict[int, list[int]] = {}
    mask = 0
    for b, r in enumerate(room):
        by_room.setdefault(r, []).append(b)
        mask |= 1 << r
    for i in sorted(items, key=lambda i: -size[i]):
        s = size[i]
        fits = mask >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                mask ^= 1 << r
        else:
            b, r = len(bins), CAPACITY
            bins.append([])
            room.append(r)
        bins[b].append(i)
        room[b] = r = r - s
        by_room.setdefault(r, []).append(b)
        mask |= 1 << r


def fitness(room: list[int]) -> float:
    """Mean squared fill: many full bins beat evenly filled ones."""
    return sum((CAPACITY - r) ** 2 for r in room) / max(1, len(room)) / CAPACITY ** 2


def _refit(keep: list[list[int]], size: list[int], n: int):
    """A packing from disjoint bins and best fit of all other items."""
    seen = bytearray(n)
    for b in keep:
        for i in b:
            seen[i] = 1
    bins = [list(b) for b in keep]
    room = [CAPACITY - sum(size[i] for i in b) for b in bins]
    best_fit([i for i in range(n) if not seen[i]], size, bins, room)
    return fitness(room), bins, room


def crossover(a, b, size: list[int], n: int, rng: random.Random):
    """Whole well-filled bins of b go into a; a's bins with duplicates go."""
    _, b_bins, b_room = b
    limit = sorted(b_room)[len(b_room) // 2]
    inject = [x for x, r in zip(b_bins, b_room) if r <= limit and rng.random() < 0.5]
    held = {i for x in inject for i in x}
    return _refit(inject + [x for x in a[1] if held.isdisjoint(x)], size, n)


def mutate(a, size: list[int], n: int, rng: random.Random):
    """Dissolve the least filled bins and a few others."""
    _, bins, room = a
    limit = sorted(room)[int(len(room) * 0.9)]
    return _refit([x for x, r in zip(bins, room) if r < limit and rng.random() < 0.95], size, n)


def evolve(size: list[int], seed: int, migrants: list[list[list[int]]], generations: int = GENERATIONS):
    """The population after some generations, best first."""
    rng = random.Random(seed)
    n = len(size)
    people = [_refit([list(b) for b in m], size, n) for m in migrants]
    if not people:
        people.append(_refit([], size, n))
    while len(people) < POPULATION:
        people.append(mutate(people[0], size, n, rng))
    for _ in range(generations):
        people.sort(key=lambda p: (-p[0], len(p[1])))
        if people[0][2] and sum(people[0][2]) < CAPACITY:
            break                                      # no packing has fewer bins
        mother, father = people[0], people[1 + rng.randrange(len(people) - 1)]
        child = crossover(mother, father, size, n, rng)
        other = mutate(crossover(father, mother, size, n, rng), size, n, rng)
        people = people[:POPULATION - 2] + [child, other]
    people.sort(key=lambda p: (-p[0], len(p[1])))
    return people


# -- the distributed algorithm -----------------------------------------------

ISLAND = "grp long, island int, rid array<long>, piece array<int>, size array<int>, " \
         "elite array<array<int>>, fit double"


def _epoch(epoch: int):
    """Task: each row is an island; evolve it and give its best packings, its
    own and the ones that migrate."""
    kind = pa.list_(pa.list_(pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                seed = zlib.crc32(f"{row['grp']}:{row['island']}:{epoch}".encode())
                people = evolve(row["size"], seed, row["elites"] or [])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["grp"]], pa.int64()), pa.array([row["island"]], pa.int32()),
                     pa.array([row["rid"]], pa.list_(pa.int64())), pa.array([row["piece"]], pa.list_(pa.int32())),
                     pa.array([row["size"]], pa.list_(pa.int32())),
                     pa.array([people[0][1]], kind), pa.array([people[0][0]], pa.float64())],
                    names=["grp", "island", "rid", "piece", "size", "elite", "fit"])
    return run


def _pack_groups(items: DataFrame, n_groups: int, level: int) -> DataFrame:
    """(grp, rid, piece, size, bin, fill) of the best packing of each group.
    ``items``: (rid, piece, length).  A group is about GROUP pieces by hash,
    whatever the documents; it is one row of arrays."""
    part = F.pmod(F.xxhash64("rid", "piece", F.lit(level)), F.lit(n_groups))
    groups = (items.groupBy(part.alias("grp"))
              .agg(F.sort_array(F.collect_list(F.struct("rid", "piece", F.col("length").cast("int").alias("size")))).alias("x")))
    islands = groups.select(
        "grp", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        F.col("x.rid").alias("rid"), F.col("x.piece").alias("piece"), F.col("x.size").alias("size"),
        F.lit(None).cast("array<array<array<int>>>").alias("elites")).repartition("grp", "island")
    for epoch in range(EPOCHS):
        evolved = stash(islands.mapInArrow(_epoch(epoch), ISLAND), "islands")
        if epoch + 1 < EPOCHS:
            # an elite visits the next island of its group
            moved = evolved.select("grp", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"),
                                   F.col("elite").alias("guest"))
            islands = evolved.join(moved, ["grp", "island"]).select(
                "grp", "island", "rid", "piece", "size", F.array("elite", "guest").alias("elites"))
    best = evolved.groupBy("grp").agg(F.max_by("island", F.struct("fit", -F.col("island"))).alias("island"))
    chosen = evolved.join(best, ["grp", "island"])
    bins = chosen.select("grp", "rid", "piece", "size", F.posexplode("elite").alias("bin", "members"))
    bins = bins.withColumn("fill", F.aggregate("members", F.lit(0), lambda s, i: s + F.element_at("size", i + 1)))
    return bins.select("grp", "bin", "fill", F.explode("members").alias("i"), "rid", "piece", "size").select(
        "grp", "bin", "fill", F.element_at("rid", F.col("i") + 1).alias("rid"),
        F.element_at("piece", F.col("i") + 1).alias("piece"),
        F.element_at("size", F.col("i") + 1).cast("long").alias("length"))


def pack(pieces: DataFrame) -> DataFrame:
    """(rid, piece, sequence_id, offset) for every piece of ``pieces``
    (rid, piece, length; each length 1 to CAPACITY)."""
    full = pieces.filter(F.col("length") == CAPACITY).select(
        "rid", "piece", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = pieces.filter(F.col("length") < CAPACITY).select("rid", "piece", "length")
    done, level = [full], 0
    while True:
        n = left.count()
        if not n:
            break
        n_groups = -(-n // GROUP)
        packed = stash(_pack_groups(left, n_groups, level), "packed")
        last = n_groups == 1
        settled = packed if last else packed.filter(F.col("fill") >= int(WELL * CAPACITY))
        if not last and settled.isEmpty():
            settled, last = packed, True               # nothing fits better
        seq = (F.lit(level << 56) + F.col("grp") * (1 << 20) + F.col("bin")).cast("long")
        done.append(settled.withColumn("sequence_id", seq).select("rid", "piece", "length", "sequence_id"))
        if last:
            break
        left = packed.filter(F.col("fill") < int(WELL * CAPACITY)).select("rid", "piece", "length")
        level += 1
    out = done[0]
    for d in done[1:]:
        # a sequence holds at most CAPACITY pieces
        seq = d.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("rid", "piece", "length"))).alias("x"))
        seq = seq.select("sequence_id", "x", F.posexplode("x").alias("k", "p"))
        out = out.unionByName(seq.select(
            "p.rid", "p.piece", "sequence_id",
            F.aggregate(F.slice("x", F.lit(1), F.col("k")), F.lit(0).cast("long"),
                        lambda s, q: s + q["length"]).alias("offset")))
    return out


def packed_documents(docs: DataFrame, path: str) -> DataFrame:
    """All pieces of ``docs`` with their place in a sequence."""
    pieces = stash(token_pieces(docs, path), "pieces")
    return (pieces.join(pack(pieces), ["rid", "piece"])
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))

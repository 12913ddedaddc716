"""Operator 8: byte-level BPE over distinct words by higher-order functions.

Method.  Texts are split by the tokenizer's pattern; tasks count their
distinct words (pieces of the pattern) and Spark adds the counts up.  Each
distinct word is encoded once: its bytes are one character each, the
character of their id, and are folded with ``aggregate``; a step joins the
leftmost adjacent pair of lowest rank to the character of the joint id.  Pairs
are looked up in a literal rank map (an array of short strings, placed by
crc32, as Spark looks a map up entry by entry and every task opens the literal).  Words of more than ``LONG`` bytes,
for which the fold's cost (the square of the length) has no bound, go
through the tokenizer library instead, also once each.  Decoding looks each
id up in the literal table of byte pieces and concatenates them.

A text is put together from its words.  The ``COMMON`` most frequent words
(of at most ``LONG`` bytes each, so bounded) are folded first and sent to all tasks.  All others
are folded where they stand, in one stage without a shuffle: a first step over the texts
writes each text as the numbers of its words and names the words that its task has not yet named, the fold runs over these
arrays, and a second step over the same rows, in the same order, keeps what was folded and
puts the texts together by number.  The first step forgets after ``FLUSH`` words, and
tells the second to forget with it, so memory is bounded and the result
never depends on the bounds.  No text moves between tasks.

Defined cases.  Null and empty texts have no ids; both digests are those of
nothing.  Null and repeated ``doc_id`` stay as rows.  Special-token strings in a text are ordinary text.  Other columns are
not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.llm.kernels import discard, stash_at

LONG = 48              # bytes; longer words are rare
COMMON = 600_000       # words sent to all tasks
MOST = 1 << 16         # word counts beyond are not told apart
PLACES = 1 << 17       # maps of the literal rank map
FLUSH = 300_000        # distinct words a task holds, while counting and while putting texts together


def read_ranks(path: str) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in Path(path).read_bytes().splitlines() if x)}


def char(i: int) -> str:
    """The character that stands for an id."""
    return chr(BASE + i)


def rank_map(ranks: dict[bytes, int]) -> Column:
    """Literal array of strings of entries: two characters (a pair of ids) and
    one that stands for the rank of the joint bytes, larger for lower ranks
    (``TOP``); all ways to cut a token in two tokens."""
    places = [""] * PLACES
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            a, b = ranks.get(token[:k]), ranks.get(token[k:])
            if a is not None and b is not None:
                pair = char(a) + char(b)
                places[zlib.crc32(pair.encode()) % PLACES] += pair + chr(TOP - rank)
    return F.from_json(F.lit(json.dumps(places, ensure_ascii=False)), "array<string>")


def join_in_rank_order(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    parts = [word[i:i + 1] for i in range(len(word))]
    while len(parts) > 1:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            break
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


def unreachable(ranks: dict[bytes, int]) -> dict[str, int]:
    """Words that are tokens but that joins alone do not make one."""
    return {t.hex().upper(): r for t, r in ranks.items() if len(join_in_rank_order(t, ranks)) > 1}


def char_table(ranks: dict[bytes, int]) -> Column:
    return F.from_json(F.lit(json.dumps([char(i) for i in range(max(ranks.values()) + 1)])), "array<string>")


def piece_table(ranks: dict[bytes, int]) -> Column:
    """Literal array: hexadecimal bytes of id i at place i + 1."""
    table = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token.hex().upper()
    return F.from_json(F.lit(json.dumps(table)), "array<string>")


def bind(value: Column, body) -> Column:
    """body(value), evaluating ``value`` once."""
    return F.element_at(F.transform(F.array(value), body), 1)


BASE = 0x400           # ids as characters start here
RANKS, TOP = 0x10000, 0x10FFFF   # characters that stand for ranks; no id is one


def fold_merges(word: Column, ranks: dict[bytes, int]) -> Column:
    """Ids of a word of one byte or more."""
    pairs, chars = rank_map(ranks), char_table(ranks)

    def rank(pair: Column) -> Column:
        """The character of the pair's rank, as a number; below RANKS: none.
        (What is behind the pair in its place, or the place itself.)"""
        place = F.element_at(pairs, (F.crc32(pair.cast("binary")) % PLACES + 1).cast("int"))
        return F.ascii(F.call_function("substring_index", place, pair, F.lit(-1)))

    def step(s: Column, _: Column) -> Column:
        of_pairs = F.transform(F.sequence(F.lit(1), F.length(s) - 1), lambda i: rank(F.substring(s, i, F.lit(2))))

        def join(r: Column) -> Column:
            best = F.array_max(r)
            at = F.array_position(r, best).cast("int")
            return F.when(best >= RANKS, F.concat(F.substring(s, F.lit(1), at - 1), F.element_at(chars, F.lit(TOP + 1) - best),
                                                  F.substring(s, at + 2, F.length(s)))).otherwise(s)
        return F.when(F.length(s) > 1, bind(of_pairs, join)).otherwise(s)

    latin = F.decode(word.cast("binary"), "ISO-8859-1")
    by_byte = F.translate(latin, "".join(map(chr, range(1, 256))),
                          "".join(char(ranks[bytes([i])]) for i in range(1, 256)))
    start = F.replace(by_byte, F.lit("\0"), F.lit(char(ranks[b"\0"])))

    def ids(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.ascii(F.substring(s, i, F.lit(1))) - BASE)
    folded = bind(bind(start, lambda s: F.aggregate(F.sequence(F.lit(1), F.length(s)), s, step)), ids)
    odd = unreachable(ranks)
    if not odd:
        return folded
    whole = F.element_at(F.from_json(F.lit(json.dumps(odd)), "map<string,int>"), F.hex(word.cast("binary")))
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(folded)


def decode(ids: Column, table: Column) -> Column:
    """Bytes of ids."""
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.element_at(table, i + 1)), ""))


def _count_words(pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        find = regex.compile(pattern).findall
        seen: Counter = Counter()
        for batch in batches:
            for t in batch.column(0):
                if t := t.as_py():
                    seen.update(find(t))
                if len(seen) > FLUSH:
                    yield pa.RecordBatch.from_pydict({"word": list(seen), "n": list(seen.values())})
                    seen.clear()
        if seen:
            yield pa.RecordBatch.from_pydict({"word": list(seen), "n": list(seen.values())})
    return run


Table = tuple[list[str], list[int], list[bytes], list[bytes]]   # words, numbers of ids, ids, bytes


def common_words(texts: DataFrame, path: str, pattern: str, common: int) -> Table:
    """The most frequent words of ``texts`` (text) that occur twice or more, as many
    whole counts as give at most ``common`` of them, of LONG bytes."""
    ranks = read_ranks(path)
    counted, at = stash_at(texts.select("text").mapInArrow(_count_words(pattern), "word string, n long")
                           .groupBy("word").agg(F.least(F.sum("n"), F.lit(MOST)).alias("n"))
                           .filter((F.octet_length("word") <= LONG) & (F.col("n") > 1)), "common")
    least, room = MOST + 1, common
    for row in counted.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.col("n").desc()).toLocalIterator():
        room -= row["words"]                    # at most MOST rows
        if room < 0:
            break
        least = row["n"]
    # few tasks, as each opens the literal map
    folded = counted.filter(F.col("n") >= least).repartition(6, "word").select("word", fold_merges(F.col("word"), ranks).alias("ids"))
    folded = folded.select("word", "ids", decode(F.col("ids"), piece_table(ranks)).alias("bytes"))
    table = folded.toArrow().combine_chunks()
    size, ids, pieces = _entries(*(table.column(c).combine_chunks() for c in ("ids", "bytes")))
    discard(texts.sparkSession, at)
    return table.column("word").to_pylist(), size, ids, pieces


def _entries(ids, pieces) -> tuple[list[int], list[bytes], list[bytes]]:
    """(number of ids, ids, bytes) of each row of the columns; a column at
    once, as rows one by one cost more than the rest."""
    size = pc.list_value_length(ids).to_pylist()
    flat = list(map(str, pc.list_flatten(ids).to_pylist()))
    joined, at = [], 0
    for n in size:
        joined.append(",".join(flat[at:at + n]).encode())
        at += n
    return size, joined, pieces.to_pylist()


NAMED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("forget", T.BooleanType()),
    T.StructField("numbers", T.BinaryType()),                        # of its words, 4 bytes each
    T.StructField("unknown", T.ArrayType(T.StringType())), T.StructField("far", T.ArrayType(T.StringType())),
])


class Numbers:
    """Texts as numbers of words: the common ones, then those that the task
    has named, in that order; -1 for a word of more than LONG bytes."""

    def __init__(self, pattern: str, common: list[str]):
        import regex
        self.find = regex.compile(pattern).findall
        self.number = {w: i for i, w in enumerate(common)}
        self.n_common = len(common)
        self.named: list[str] = []

    def forget(self) -> None:
        for word in self.named:
            del self.number[word]
        self.named = []

    def of_text(self, text: str) -> tuple[list[int], list[str], list[str]]:
        """(numbers, words named first here, long words in their order)."""
        words, number, far, before = self.find(text), self.number, [], len(self.named)
        got = list(map(number.get, words))
        for i, n in enumerate(got):
            if n is None:
                word = words[i]
                n = number.get(word)
                if n is None and len(word.encode()) > LONG:
                    n = -1
                    far.append(word)
                elif n is None:
                    n = number[word] = self.n_common + len(self.named)
                    self.named.append(word)
                got[i] = n
        return got, self.named[before:], far


def _name_unknown(pattern: str, shared, flush: int):
    """Task: each text as numbers, with the words that are neither common nor named yet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = Numbers(pattern, shared.value)
        for batch in batches:
            forget, rows = [], []
            for t in batch.column(1):
                forget.append(len(to.named) > flush)
                if forget[-1]:
                    to.forget()
                numbers, unknown, far = to.of_text(t.as_py())
                rows.append((array("i", numbers).tobytes(), unknown, far))
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(forget, pa.bool_()), pa.array([r[0] for r in rows], pa.binary()),
                 pa.array([r[1] for r in rows], strings), pa.array([r[2] for r in rows], strings)], names=NAMED.fieldNames())
    return run


DONE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
])


class Assembler:
    """Puts texts together from their words."""

    def __init__(self, path: str, pattern: str, common: tuple[list[int], list[bytes], list[bytes]]):
        self.path, self.pattern, self.n_common = path, pattern, len(common[0])
        self.size, self.ids, self.pieces = common     # of words by number

    def forget(self) -> None:
        for column in (self.size, self.ids, self.pieces):
            del column[self.n_common:]

    def far(self, word: str) -> tuple[int, bytes, bytes]:
        """A word of more than LONG bytes, by the tokenizer library."""
        ids = _library(self.path, self.pattern).encode_ordinary(word)
        return len(ids), ",".join(map(str, ids)).encode(), _library(self.path, self.pattern).decode_bytes(ids)

    def digest(self, numbers: list[int], far: list[str]) -> tuple[int, str, str]:
        """(n_tokens, ids_sha256, decoded_sha256)."""
        if far:
            words = iter(far)
            size, ids, pieces = zip(*(self.far(next(words)) if n < 0 else (self.size[n], self.ids[n], self.pieces[n])
                                      for n in numbers), strict=True)
        else:
            size, ids, pieces = (map(column.__getitem__, numbers) for column in (self.size, self.ids, self.pieces))
        return sum(size), hashlib.sha256(b",".join(ids)).hexdigest(), hashlib.sha256(b"".join(pieces)).hexdigest()


@lru_cache(1)
def _library(path: str, pattern: str):
    import tiktoken
    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


def _assemble(path: str, pattern: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # lists of this task's own: what it names is put behind
        to = Assembler(path, pattern, tuple(map(list, shared.value)))
        for batch in batches:
            got = []
            flat, at = pc.list_flatten(batch.column(3)), 0
            size, ids, pieces = _entries(flat.field("ids"), flat.field("bytes")) if len(flat) else ([], [], [])
            for numbers, forget, n, far in zip(batch.column(1), batch.column(2).to_pylist(),
                                               pc.list_value_length(batch.column(3)).to_pylist(), batch.column(4).to_pylist()):
                if forget:
                    to.forget()
                to.size += size[at:at + n]
                to.ids += ids[at:at + n]
                to.pieces += pieces[at:at + n]
                at += n
                got.append(to.digest(array("i", numbers.as_py()).tolist(), far))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string()),
                 pa.array([g[2] for g in got], pa.string())], names=DONE.fieldNames())
    return run


def encode_digests(docs: DataFrame, path: str, pattern: str, common: int = COMMON, flush: int = FLUSH) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words, *entries = common_words(texts, path, pattern, common)
    context = docs.sparkSession.sparkContext
    names, known = context.broadcast(words), context.broadcast(entries)
    ranks = read_ranks(path)
    pieces = piece_table(ranks)

    def folded(word: Column) -> Column:
        return bind(fold_merges(word, ranks), lambda ids: F.struct(ids.alias("ids"), decode(ids, pieces).alias("bytes")))
    return (texts.mapInArrow(_name_unknown(pattern, names, flush), NAMED)
            .select("doc_id", "numbers", "forget", F.transform("unknown", folded).alias("words"), "far")
            .mapInArrow(_assemble(path, pattern, known), DONE))

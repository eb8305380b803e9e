"""Alignment of two tokenizers over a corpus: which of their tokens share bytes, and how often.

Both tokenizers cut the same bytes. Offsets where both end a token cut a text into groups; each token of the one is
linked to each of the other in its group. The first pass encodes every text once, keeps the ids as compressed
blocks, and tells the distinct pairs of every block and how many of its documents hold them. Distinct pairs are
dealt out to parts by hash; each part gets a minimal perfect hash function (a cascade of bit arrays with a rank
directory, one slot per pair) with the pair of each slot beside it, so that a look-up is verified. Counts are dense
vectors by slot, summed up as a tree. The second pass aligns the blocks again and looks up its pairs' counts.

A part's pieces are dealt out to as many groups as their number asks for, so no task grows with the input. There are
at most as many pairs as the product of both vocabularies, so the number of parts is bounded, whatever the input.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm import blocks as B
from postmill.llm.common import cut
from postmill.session import scratch_path

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
# Text bytes of a block, links expanded at a time, pairs of a part, and entries of a group of its pieces.
BLOCK_BYTES, LINKS, PART_PAIRS, GROUP_PAIRS = 4 << 20, 1 << 20, 1_000_000, 4_000_000
# A document's part in a packed (document, pair): pairs have 32 bits.
PAIR_BITS = np.int64(32)
# The cascade: bits per key of a level, and levels before the rest is listed.
GAMMA, CASCADE = 2.0, 24

# A run of blanks this long is left to the reference library: the fast one's pattern search runs out of stack on it.
LONG_BLANK = re.compile(r"\s{4000}")
# Fixed value: how the byte-level tokenizer splits a text before it merges bytes.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# --- Tokenizers ---------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Files:
    """Both tokenizers' files as bytes (a few MB), so that executors need no path."""
    a: bytes
    b: bytes

    @staticmethod
    def read(a: str = TOKENIZER_A, b: str = TOKENIZER_B) -> Files:
        with open(a, "rb") as fa, open(b, "rb") as fb:
            return Files(fa.read(), fb.read())


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Pair:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, files: Files):
        import sentencepiece
        import tiktoken

        spec = json.loads(files.a)
        special = {x["id"] for x in spec["added_tokens"]}
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in t): i for t, i in spec["model"]["vocab"].items() if i not in special}
        self.enc = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=files.b)
        self.spec = files.a.decode()
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.bytes_a[i] = t
        self.bytes_b = [self._piece(i) for i in range(self.sp.get_piece_size())]

    def _piece(self, i: int) -> bytes:
        p = self.sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace("▁", " ").encode()

    def _encode_a(self, text: str) -> list[int]:
        if not LONG_BLANK.search(text):
            return self.enc.encode_ordinary(text)
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(self.spec)
        t.encode_special_tokens = True
        return t.encode(text, add_special_tokens=False).ids

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids by A and by B; none where the text is null or empty, or a tokenizer does not give back its bytes."""
        none = np.empty(0, np.uint32), np.empty(0, np.uint32)
        if not text:
            return none
        want = b" " + text.encode()
        a = self._encode_a(" " + text)
        b = self.sp.encode(text, num_threads=1)
        if b"".join(map(self.bytes_a.__getitem__, a)) != want or b"".join(map(self.bytes_b.__getitem__, b)) != want:
            return none
        return np.array(a, np.uint32), np.array(b, np.uint32)


@lru_cache(maxsize=2)
def _pair(files: Files) -> Pair:
    return Pair(files)


# --- Alignment of one block ---------------------------------------------------------------------------------------

@dataclass
class Aligned:
    """Tokens of a block with their groups: ids, group of each token, whether it ends one, tokens before each group."""
    a: np.ndarray
    b: np.ndarray
    in_a: np.ndarray
    in_b: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray
    from_a: np.ndarray
    from_b: np.ndarray


def align(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> Aligned:
    """Groups of tokens of the same bytes; ``size_*`` are the tokens' byte lengths by id."""
    end_a, end_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
    ends = np.zeros((end_a[-1] if len(a) else 0) + 1, np.uint8)
    ends[end_a] |= 1
    ends[end_b] |= 2
    last_a, last_b = ends[end_a] == 3, ends[end_b] == 3
    in_a, in_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    n = int(last_a.sum())
    from_a, from_b = (np.r_[0, np.cumsum(np.bincount(x, minlength=n))].astype(np.int64) for x in (in_a, in_b))
    return Aligned(a, b, in_a, in_b, last_a, last_b, from_a, from_b)


def links(x: Aligned, doc_a: np.ndarray, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (document, pair) of a block, packed, with the number of links each stands for.

    Links are expanded a million at a time, so a group of many tokens on both sides takes no more memory.
    """
    per = (x.from_b[1:] - x.from_b[:-1])[x.in_a]
    upto = np.cumsum(per)
    found, times, at = [], [], 0
    while at < len(per):
        done = upto[at - 1] if at else 0
        end = max(int(np.searchsorted(upto, done + LINKS, "right")), at + 1)
        n = per[at:end]
        first = np.cumsum(n) - n
        which = np.repeat(np.arange(at, end), n)
        b = x.b[np.repeat(x.from_b[x.in_a[at:end]] - first, n) + np.arange(n.sum())]
        packed = (doc_a[which] << PAIR_BITS) | (x.a[which].astype(np.int64) * n_b + b)
        u, c = np.unique(packed, return_counts=True)
        found.append(u)
        times.append(c)
        at = end
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if len(found) == 1:
        return found[0], times[0]
    # Chunks follow each other by document, so only a document cut by a chunk is in two.
    u, c = np.concatenate(found), np.concatenate(times)
    order = np.argsort(u, kind="stable")
    u, c = u[order], c[order]
    new = np.flatnonzero(np.r_[True, u[1:] != u[:-1]])
    return u[new], np.add.reduceat(c, new)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of unsigned numbers (the finalizer of splitmix64)."""
    x = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & ((1 << 64) - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def part_of(pairs: np.ndarray, n_parts: int) -> np.ndarray:
    return (_mix(pairs, 0) % np.uint64(n_parts)).astype(np.int64)


# --- Minimal perfect hashing --------------------------------------------------------------------------------------

@dataclass
class Perfect:
    """A minimal perfect hash of a set of numbers: bit arrays one after the other, with the ones before each byte.

    A key's slot is the rank of its bit in the first level where no other key shares its place; the last keys, if
    any, are listed and take the last slots. ``keys`` holds the key of each slot.
    """
    sizes: np.ndarray
    bits: np.ndarray
    ones: np.ndarray
    rest: np.ndarray
    keys: np.ndarray

    @staticmethod
    def build(keys: np.ndarray) -> Perfect:
        left, sizes, levels = keys, [], []
        while len(left) and len(sizes) < CASCADE:
            m = max(64, int(GAMMA * len(left))) + 7 & ~7
            at = (_mix(left, len(sizes) + 1) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            sizes.append(m)
            left = left[~alone[at]]
        bits = np.concatenate(levels) if levels else np.empty(0, np.uint8)
        ones = np.r_[0, np.cumsum(np.bitwise_count(bits), dtype=np.int64)]
        out = Perfect(np.array(sizes, np.int64), bits, ones, np.sort(left), np.empty(len(keys), np.int64))
        out.keys[out._slots(keys)] = keys
        return out

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        slots = np.full(len(keys), -1, np.int64)
        left, start = np.arange(len(keys)), 0
        for level, m in enumerate(self.sizes.tolist()):
            at = start + (_mix(keys[left], level + 1) % np.uint64(m)).astype(np.int64)
            byte, bit = at >> 3, (at & 7).astype(np.uint8)
            hit = (self.bits[byte] >> bit) & 1 == 1
            below = np.bitwise_count(self.bits[byte[hit]] & ((np.uint8(1) << bit[hit]) - np.uint8(1)))
            slots[left[hit]] = self.ones[byte[hit]] + below
            left, start = left[~hit], start + m
        if len(self.rest):
            at = np.searchsorted(self.rest, keys[left]).clip(max=len(self.rest) - 1)
            known = self.rest[at] == keys[left]
            slots[left[known]] = self.ones[-1] + at[known]
        return slots

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, verified; -1 for a key that is not in the set."""
        s = self._slots(keys)
        if len(self.keys):
            s[(s >= 0) & (self.keys[s.clip(0)] != keys)] = -1
        return s

    def arrays(self) -> dict[str, np.ndarray]:
        return {k: getattr(self, k) for k in ("sizes", "bits", "ones", "rest", "keys")}

    @staticmethod
    def of(z: dict[str, np.ndarray]) -> Perfect:
        return Perfect(*[z[k] for k in ("sizes", "bits", "ones", "rest", "keys")])


# --- The corpus ---------------------------------------------------------------------------------------------------

def _encode(docs: DataFrame, files: Files, id_col: str, text_col: str) -> B.Blocks:
    """The table of blocks (block, payload): ids of whole texts, in the shared checkpoint folder, bucketed by block."""
    limit = BLOCK_BYTES

    def gather(batches):
        from pyspark import TaskContext

        pair, task, made, size = _pair(files), TaskContext.get().partitionId(), 0, 0
        ids, a, b = [], [], []

        def block():
            z = {"ids": np.array(ids, np.int64)}
            for name, x in (("a", a), ("b", b)):
                tokens = np.concatenate(x)
                z[name] = tokens.astype(np.uint16) if len(tokens) == 0 or tokens.max() < 1 << 16 else tokens
                z[f"n_{name}"] = np.array([len(y) for y in x], np.int64)
            return pa.RecordBatch.from_pydict({"block": pa.array([(task << 32) + made], pa.int64()), "payload": pa.array([B._frozen(z)], pa.binary())})

        for row in B.one_by_one(batches):
            x, y = pair.encode(row["text"])
            ids.append(B.NO_ID if row["id"] is None else row["id"])
            a.append(x)
            b.append(y)
            size += len((row["text"] or "").encode())
            if size >= limit:
                yield block()
                made, size, ids, a, b = made + 1, 0, [], [], []
        if ids:
            yield block()

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    n_bytes = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(1, -(-n_bytes // B.BUCKET_BYTES))
    path = scratch_path(docs.sparkSession, "aligned")
    table = "aligned_" + path.rsplit("-", 1)[1]
    (d.mapInArrow(gather, "block long, payload binary").write.format("parquet").option("compression", "none")
     .bucketBy(n_buckets, "block").option("path", path).saveAsTable(table))
    return B.Blocks(docs.sparkSession.table(table), n_buckets, n_bytes)


@dataclass
class Block:
    """A block as both passes see it: documents, their alignment, and their distinct pairs."""
    ids: np.ndarray
    n: dict[str, np.ndarray]
    x: Aligned
    doc_a: np.ndarray
    packed: np.ndarray
    times: np.ndarray

    @staticmethod
    def of(payload: bytes, sizes: tuple[np.ndarray, np.ndarray]) -> Block:
        z = B._thawed(payload)
        doc_a = np.repeat(np.arange(len(z["ids"])), z["n_a"])
        x = align(z["a"], z["b"], *sizes)
        packed, times = links(x, doc_a, len(sizes[1]))
        return Block(z["ids"], {"a": z["n_a"], "b": z["n_b"]}, x, doc_a, packed, times)

    @property
    def pairs(self) -> np.ndarray:
        return self.packed & ((np.int64(1) << PAIR_BITS) - 1)


def _tree(df: DataFrame, n: int, fan_in: int, combine) -> DataFrame:
    """(part, data) of (part, slot < n, data): the pieces of a part combined ``fan_in`` slots at a time."""
    def merged(key, group):
        return pa.table({"part": [key[0].as_py()], "slot": pa.array([key[1].as_py()], pa.int64()),
                         "data": pa.array([B._frozen(combine([B._thawed(x.as_py()) for x in group["data"]]))], pa.binary())})

    while True:
        n = -(-n // fan_in)
        df = df.select("part", (F.col("slot") % n).alias("slot"), "data").groupBy("part", "slot").applyInArrow(merged, "part long, slot long, data binary")
        if n == 1:
            return cut(df.select("part", "data"))


def _summed(arrays: list[dict]) -> dict:
    return {"n": np.sum([z["n"] for z in arrays], axis=0)}


def _united(arrays: list[dict]) -> dict:
    return {"keys": np.unique(np.concatenate([z["keys"] for z in arrays]))}


def count_pairs(table: DataFrame, sizes: tuple, n_parts: int, fan_in: int = 16):
    """(answers (block, part, answer), best): the counts of every block's pairs by part, and of each A id the highest.

    ``best`` is an array by A id, so at most as long as the vocabulary.
    """
    n_b, n_a = len(sizes[1]), len(sizes[0])

    def told(batches):
        for row in B.one_by_one(batches):
            pairs, n = np.unique(Block.of(row["payload"], sizes).pairs, return_counts=True)
            part = part_of(pairs, n_parts)
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(n_parts + 1))
            for p in np.flatnonzero(np.diff(edges)).tolist():
                at = order[edges[p]:edges[p + 1]]
                z = {"keys": pairs[at].astype(np.uint32), "n": n[at].astype(np.uint32)}
                yield pa.RecordBatch.from_pydict({"part": pa.array([p], pa.int64()), "block": pa.array([row["block"]], pa.int64()),
                                                  "size": pa.array([len(at)], pa.int64()), "data": pa.array([B._frozen(z)], pa.binary())})

    path = scratch_path(table.sparkSession, "pieces")
    table.mapInArrow(told, "part long, block long, size long, data binary").write.option("compression", "none").parquet(path)
    pieces = table.sparkSession.read.parquet(path)
    most = pieces.groupBy("part").agg(F.sum("size").alias("n")).agg(F.max("n")).first()[0] or 0
    # Groups of a part: as many as its pieces fill.
    n = max(1, -(-most // GROUP_PAIRS))
    pieces = pieces.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(n)))

    def keys_of(key, group):
        z = [B._thawed(x.as_py()) for x in group["data"]]
        return pa.table({"part": [key[0].as_py()], "slot": pa.array([key[1].as_py()], pa.int64()),
                         "data": pa.array([B._frozen({"keys": np.unique(np.concatenate([y["keys"] for y in z])).astype(np.int64)})], pa.binary())})

    def hashed(batches):
        for row in B.one_by_one(batches):
            yield pa.RecordBatch.from_pydict({"part": pa.array([row["part"]], pa.int64()),
                                              "hash": pa.array([B._frozen(Perfect.build(B._thawed(row["data"])["keys"]).arrays())], pa.binary())})

    united = pieces.groupBy("part", "slot").applyInArrow(keys_of, "part long, slot long, data binary")
    perfect = cut(_tree(united, n, fan_in, _united).mapInArrow(hashed, "part long, hash binary"))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("slot")

    def counted(key, group, own):
        h = Perfect.of(B._thawed(own["hash"][0].as_py()))
        total = np.zeros(len(h.keys), np.int64)
        for x in group["data"]:
            z = B._thawed(x.as_py())
            total[h.find(z["keys"].astype(np.int64))] += z["n"]
        return pa.table({"part": [key[0].as_py()], "slot": pa.array([key[1].as_py()], pa.int64()), "data": pa.array([B._frozen({"n": total})], pa.binary())})

    grouped = pieces.groupBy("part", "slot")
    vectors = grouped.cogroup(perfect.select("part", "hash", copies).groupBy("part", "slot")).applyInArrow(counted, "part long, slot long, data binary")
    counts = cut(perfect.join(_tree(vectors, n, fan_in, _summed), "part"))

    def highest(batches):
        for row in B.one_by_one(batches):
            a, c = Perfect.of(B._thawed(row["hash"])).keys // n_b, B._thawed(row["data"])["n"]
            top = np.zeros(n_a, np.int64)
            np.maximum.at(top, a, c)
            held = np.flatnonzero(top)
            yield pa.RecordBatch.from_pydict({"a": held, "n": top[held]})

    best = np.zeros(n_a, np.int64)
    for r in counts.mapInArrow(highest, "a long, n long").groupBy("a").agg(F.max("n").alias("n")).collect():
        best[r["a"]] = r["n"]

    def answer(key, group, own):
        h, total = Perfect.of(B._thawed(own["hash"][0].as_py())), B._thawed(own["data"][0].as_py())["n"]
        found = [B._frozen({"n": total[h.find(B._thawed(x.as_py())["keys"].astype(np.int64))]}) for x in group["data"]]
        return pa.table({"block": group["block"], "part": group["part"], "answer": pa.array(found, pa.binary())})

    answers = grouped.cogroup(counts.select("part", "hash", "data", copies).groupBy("part", "slot")).applyInArrow(
        answer, "block long, part long, answer binary")
    return cut(answers), best


OUT = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


def align_corpus(docs: DataFrame, files: Files | None = None, id_col: str = "doc_id", text_col: str = "text", groups: bool = False) -> DataFrame:
    """One row per input row: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups]).

    ``files`` are the two tokenizers (by default those of ``TOKENIZER_A`` and ``TOKENIZER_B``); with ``groups`` the alignment itself is returned as text,
    ``a1,a2|b1;a3|b2`` in ids. Null and empty texts, and texts that a tokenizer does not give back byte by byte, have no
    tokens: zeros and empty strings. Repeated rows are documents each; a table without documents gives no rows.
    """
    files = files or Files.read()
    pair = Pair(files)
    sizes = tuple(np.array([len(t) for t in x], np.int64) for x in (pair.bytes_a, pair.bytes_b))
    n_a, n_b = map(len, sizes)
    source = _encode(docs, files, id_col, text_col)
    # A distinct pair takes some bytes of text, and the vocabularies have only so many.
    n_parts = B.parts_for(min(source.n_bytes / 64, n_a * n_b), PART_PAIRS)
    answers, best = count_pairs(source.table, sizes, n_parts)
    words = [b"%d%c" % (i, c) for i in range(n_a) for c in b",|"] + [b"%d%c" % (i, c) for i in range(n_b) for c in b",;"]

    def per_doc(values: np.ndarray, docs_of: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        np.add.at(out, docs_of, values)
        return out

    def rows(batches):
        for row in B.one_by_one(batches):
            k = Block.of(row["payload"], sizes)
            n, x = len(k.ids), k.x
            pairs, where = np.unique(k.pairs, return_inverse=True)
            by_part = np.argsort(part_of(pairs, n_parts), kind="stable")
            counts = np.empty(len(pairs), np.int64)
            counts[by_part] = B.joined(row["a0"], "n", np.int64)
            counts, doc = counts[where], k.packed >> PAIR_BITS
            is_best = counts == best[(k.pairs // n_b)]
            out = {"n_links": per_doc(k.times, doc, n), "n_best": per_doc(k.times * is_best, doc, n), "count_sum": per_doc(k.times * counts, doc, n),
                   "n_groups": per_doc(x.last_a.astype(np.int64), k.doc_a, n)}
            # Tokens of both in the order of groups, A's before B's, each with what follows it.
            text = np.empty(len(x.a) + len(x.b), np.int32)
            text[np.arange(len(x.a)) + x.from_b[x.in_a]] = x.a.astype(np.int32) * 2 + x.last_a
            text[np.arange(len(x.b)) + x.from_a[x.in_b + 1]] = 2 * n_a + x.b.astype(np.int32) * 2 + x.last_b
            ends = np.cumsum(k.n["a"] + k.n["b"])
            digests, texts = [], []
            for s, e in zip((ends - k.n["a"] - k.n["b"]).tolist(), ends.tolist()):
                joined = b"".join(map(words.__getitem__, text[s:e].tolist()))[:-1]
                digests.append(sha256(joined).hexdigest() if joined else "")
                texts.append(joined.decode() if groups else None)
            ids = pa.array(k.ids, mask=k.ids == B.NO_ID)
            yield pa.RecordBatch.from_pydict({"id": ids, "n_a": k.n["a"], "n_b": k.n["b"], "n_groups": out["n_groups"], "n_links": out["n_links"],
                                              "n_best": out["n_best"], "count_sum": out["count_sum"], "groups_sha256": digests,
                                              "groups": pa.array(texts, pa.string())})

    out = B.answered(source, answers).select("payload", "a0").mapInArrow(rows, OUT)
    return (out if groups else out.drop("groups")).withColumnRenamed("id", id_col)

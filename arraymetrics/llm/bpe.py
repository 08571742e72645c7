"""BPE encoding and decoding that encodes content shared between documents once.

Texts are cut where a rolling hash says so, hence alike wherever the same content stands. A chunk's interior lies
between its first and last *safe break*: a blank right after a visible ASCII character. No word of a byte-level tokenizer's
pattern spans such a place, and what follows it is split in the same way whatever precedes it, so interiors can be
encoded apart. The rest of a join, from the last safe break of one chunk to the first of the next, is encoded
again as one piece; where a chunk has no two safe breaks, the join runs on through it until one is found. The ids so put
together are those of the whole text (tests compare them with the tokenizers library).
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import grams8, mix, slices, small_batches, span_keys, stored, text_buffer

#: Mean and least bytes from one cut to the next, and the rolling hash's window.
CHUNK, LEAST, WINDOW = 1024, 64, 16
#: The filter of shared chunks takes 16 bits for each, and so much at most. A fuller filter only sends more
#: chunks through the shuffle; the ids stay exact.
FILTER_BITS = 1 << 27
FILTER_PARTS = 64


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(2)
def load(path: str):
    """Encoder and the bytes of every id, from a byte-level BPE file of the tokenizers library."""
    import tiktoken
    from tokenizers.pre_tokenizers import ByteLevel

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec["pre_tokenizer"] or {}
    if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"] or not pre.get("use_regex", True):
        raise ValueError(f"{path} is not a plain byte-level BPE")
    visible = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    letter = {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in visible)}
    if set(letter) != set(ByteLevel.alphabet()):
        raise ValueError("unknown byte alphabet")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(letter[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    table = {i: b for b, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
    encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return encoding, [table.get(i, b"") for i in range(max(table) + 1)]


#: Fixed value: the published word pattern of byte-level BPE vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: Fixed value: what the pattern counts as blank. Runs of RUN and more are cut out before the pattern sees them, since it gives up on very long ones.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUN = 10_000
_LONG_RUN = re.compile(f"(?<![{BLANKS}])[{BLANKS}]{{{RUN},}}+")


def encode_text(encoding, text: str) -> np.ndarray:
    """The ids of a text. A run of blanks is one word of the pattern, but for its last blank where text follows that is no special token; so a very
    long run is encoded apart, and what stands around it too."""
    plain = lambda t: encoding.encode(t, allowed_special="all", disallowed_special=())
    out, at = [], 0
    for run in _LONG_RUN.finditer(text) if len(text) >= RUN else ():
        whole = run.end() == len(text) or any(text.startswith(t, run.end()) for t in encoding.special_tokens_set)
        end = run.end() if whole else run.end() - 1
        out += [plain(text[at : run.start()]), blank_ids(encoding, text[run.start() : end])]
        at = end
    return np.concatenate([np.asarray(x, np.uint32) for x in [*out, plain(text[at:])]])


def blank_ids(encoding, run: str) -> list[int]:
    """The ids of one word of blanks."""
    return encoding._encode_single_piece(run.encode())


@functools.lru_cache(2)
def _edges(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Which ids begin with a blank, and which end with a visible ASCII character."""
    table = load(path)[1]
    return np.array([b[:1] in (b" ", b"\n") for b in table]), np.array([len(b) > 0 and 32 < b[-1] < 127 for b in table])


def repaired(gaps: list[str], codes: list[np.ndarray], path: str) -> np.ndarray:
    """The ids of a text from those of its chunks and the text around them (one piece more than there are chunks).

    A join is encoded again together with a word of the chunk on either side, and these must come out as the chunk's own ids; until
    they agree the join takes in more words, twice as many each time, up to the whole of both chunks.
    """
    encoding, table = load(path)
    opens, shuts = _edges(path)
    none = np.zeros(0, np.uint32)
    breaks = lambda x: np.flatnonzero(opens[x[1:]] & shuts[x[:-1]]) + 1
    plain = lambda x: b"".join([table[t] for t in x.tolist()]).decode("utf-8", "replace")
    out, left = [], none
    for gap, right in zip(gaps, [*codes, none], strict=True):
        before, behind, words = breaks(left), breaks(right), 1
        while True:
            a = int(before[-1 - words]) if len(before) > words else 0
            b = int(behind[words]) if len(behind) > words else len(right)
            got = encode_text(encoding, plain(left[a:]) + gap + plain(right[:b]))
            keep, drop = int(before[-1]) - a if a else 0, b - int(behind[0]) if b < len(right) else 0
            if keep + drop <= len(got) and (got[:keep] == left[a : a + keep]).all() and (got[len(got) - drop :] == right[b - drop : b]).all():
                break
            words *= 2
        out += [left[: a + keep], got[keep : len(got) - drop]]
        left = right[b - drop :]
    return np.concatenate(out)


def _cuts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Places of the cuts in a slice of texts: the end of a window whose hash is 0 modulo CHUNK, inside one text,
    not within a UTF-8 character, and LEAST bytes after the last."""
    if len(data) < WINDOW:
        return np.zeros(0, np.int64)
    g = grams8(data)
    end = np.arange(WINDOW, len(data))
    h = mix(g[: len(end)] * np.uint64(0x9E3779B97F4A7C15) + g[8 : 8 + len(end)])
    end = end[(h % np.uint64(CHUNK) == 0) & ((data[WINDOW:] & 0xC0) != 0x80)]
    row = np.searchsorted(offs, end, side="right") - 1
    inside = end - WINDOW >= offs[row]
    end, row = end[inside], row[inside]
    if len(end) and ((np.diff(end) < LEAST) & (row[1:] == row[:-1])).any():
        kept, last, of = [], -LEAST, -1
        for x, r in zip(end.tolist(), row.tolist(), strict=True):
            if r != of or x - last >= LEAST:
                kept.append(x)
                last, of = x, r
        end = np.array(kept, np.int64)
    return end


def chunks(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text, start, end and two hashes of the interior of every chunk of a slice that has one."""
    cuts = _cuts(data, offs)
    edge = np.unique(np.concatenate([offs, cuts]))
    blank = (data == 32) | (data == 10)
    safe = np.flatnonzero(blank[1:] & (data[:-1] > 32) & (data[:-1] < 127)) + 1 if len(data) else np.zeros(0, np.int64)
    row = np.searchsorted(offs, edge[:-1], side="right") - 1
    a = np.searchsorted(safe, edge[:-1], side="right")  # a break at the very edge may look different from within
    b = np.searchsorted(safe, edge[1:], side="left") - 1
    ok = np.flatnonzero(b > a)
    start, end = safe[a[ok]], safe[b[ok]]
    key = span_keys(data, start, end)
    return row[ok], start, end, key[:, 0], key[:, 1]


def _slots(h1: np.ndarray, bits: int) -> list[np.ndarray]:
    h, step = h1, (mix(h1) | np.uint64(1))
    return [((h + np.uint64(j) * step) % np.uint64(bits)).astype(np.int64) for j in range(4)]


def _shared_filter(docs: DataFrame) -> tuple[np.ndarray, int]:
    """A Bloom filter, as packed bits, of the chunks that stand at two places or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_buffer(b.column("text"))
            for i, j in slices(offs):
                _, _, _, h1, h2 = chunks(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                yield pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))], ["h1", "h2"])

    shared = stored(docs.select("text").mapInArrow(run, "h1 long, h2 long").groupBy("h1", "h2").count().where("count > 1").select("h1"))
    bits = int(min(FILTER_BITS, max(1 << 12, 16 * shared.count())))
    bits -= bits % (8 * FILTER_PARTS)
    size = bits // FILTER_PARTS

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.concatenate(_slots(b.column("h1").to_numpy().view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays([pa.array((s // size).astype(np.int32)), pa.array((s % size).astype(np.int32))], ["part", "bit"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            part, bit = b.column("part").to_numpy(), b.column("bit").to_numpy()
            for p in np.unique(part):
                held.setdefault(int(p), np.zeros(size, bool))[bit[part == p]] = True
        for p, on in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([np.packbits(on).tobytes()], pa.binary())], ["part", "bits"])

    out = np.zeros(bits // 8, np.uint8)
    placed = shared.mapInArrow(place, "part int, bit int").distinct().repartition(FILTER_PARTS, "part")
    for r in placed.mapInArrow(pack, "part int, bits binary").collect():
        out[r.part * (size // 8) : (r.part + 1) * (size // 8)] |= np.frombuffer(r.bits, np.uint8)
    return out, bits


def _known(h1: np.ndarray, packed: np.ndarray, bits: int) -> np.ndarray:
    on = np.ones(len(h1), bool)
    for s in _slots(h1, bits):
        on &= (packed[s >> 3] >> (7 - (s & 7)).astype(np.uint8) & 1).astype(bool)
    return on


def _width(table: list[bytes]) -> str:
    return "<u2" if len(table) <= 1 << 16 else "<u4"


def _plain(raw: np.ndarray) -> str:
    return raw.tobytes().decode("utf-8", "replace")


CODES = "doc_id long, ids binary, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _out(ids: list, codes: list[np.ndarray], table: list[bytes], digest: bool) -> pa.RecordBatch:
    decoded = [b"".join([table[t] for t in c.tolist()]).decode("utf-8", "replace") for c in codes]
    raw = [c.astype("<u4").tobytes() for c in codes]
    if not digest:
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(raw, pa.binary()), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([len(c) for c in codes], pa.int64()), pa.array([sha(x) for x in raw], pa.string()), pa.array([sha(x.encode()) for x in decoded], pa.string())],
        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


def encode_decode(docs: DataFrame, vocabulary: str | None = None, digest: bool = False) -> DataFrame:
    """Encode every text, then decode the ids again: doc_id, ids (little-endian unsigned 32-bit integers), decoded;
    or, with ``digest``, n_tokens and the SHA-256 of both instead.

    A null text is empty; an empty text has no ids. Special tokens standing in a text become their ids, as the tokenizers
    library does by default. Repeated rows give equal rows; null ids stay null. The vocabulary's path must be readable on
    every executor.

    Chunks seen once are encoded where they are read. Texts with a chunk that the filter knows are written out; each such chunk
    is encoded once, by a group over its hashes with map-side combining, and joined back to its texts.
    """
    path = vocabulary or default_vocabulary()
    spark = docs.sparkSession
    small_batches(spark)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    packed, bits = _shared_filter(src)
    known = spark.sparkContext.broadcast(packed)
    names = [x.split()[0] for x in (DIGESTS if digest else CODES).split(", ")]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, table = load(path)
        for b in batches:
            data, offs = text_buffer(b.column("text"))
            ids = b.column("doc_id").to_pylist()
            for i, j in slices(offs):
                part, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                row, _, _, h1, _ = chunks(part, o)
                wait = np.zeros(j - i, bool)
                wait[row[_known(h1, known.value, bits)]] = True
                here = np.flatnonzero(~wait)
                done = _out([ids[i + r] for r in here], [encode_text(encoding, _plain(part[o[r] : o[r + 1]])) for r in here], table, digest)
                held = np.flatnonzero(wait)
                texts = [_plain(part[o[r] : o[r + 1]]).encode() for r in held]
                key = np.array([xxhash.xxh3_64_intdigest(x) for x in texts], np.uint64).view(np.int64)
                late = [pa.array([ids[i + r] for r in held], pa.int64())] + [pa.nulls(len(held), done.column(n).type) for n in names[1:]]
                for cols, key_, text in (
                    (done.columns, pa.nulls(len(here), pa.int64()), pa.nulls(len(here), pa.string())),
                    (late, pa.array(key), b.column("text").slice(i, j - i).take(pa.array(held))),
                ):
                    yield pa.RecordBatch.from_arrays([*cols, key_, text], [*names, "key", "text"])

    mixed = stored(src.mapInArrow(first, f"{DIGESTS if digest else CODES}, key long, text string"))
    done = mixed.where("key is null").select(*names)
    waiting = mixed.where("key is not null").select("doc_id", "key", "text")

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_buffer(b.column("text"))
            for i, j in slices(offs):
                part = data[offs[i] : offs[j]]
                row, start, end, h1, h2 = chunks(part, offs[i : j + 1] - offs[i])
                on = np.flatnonzero(_known(h1, known.value, bits))
                texts = [_plain(part[s:e]) for s, e in zip(start[on], end[on], strict=True)]
                take = lambda n: b.column(n).slice(i, j - i).take(pa.array(row[on]))
                yield pa.RecordBatch.from_arrays([take("doc_id"), take("key"), pa.array(h1[on].view(np.int64)), pa.array(h2[on].view(np.int64)), pa.array(texts, pa.string())], ["doc_id", "key", "h1", "h2", "body"])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, table = load(path)
        for b in batches:
            got = [encode_text(encoding, x).astype(_width(table)).tobytes() for x in b.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("h1"), b.column("h2"), pa.array(got, pa.binary())], ["h1", "h2", "code"])

    def rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What a text has around its known chunks: one piece more than there are chunks."""
        for b in batches:
            data, offs = text_buffer(b.column("text"))
            out = []
            for i in range(len(b)):
                text = data[offs[i] : offs[i + 1]]
                _, start, end, h1, h2 = chunks(text, np.array([0, len(text)]))
                on = _known(h1, known.value, bits)
                edges = zip([0, *end[on].tolist()], [*start[on].tolist(), len(text)], strict=True)
                out.append(([_plain(text[s:e]) for s, e in edges], h1[on].view(np.int64), h2[on].view(np.int64)))
            gaps, one, two = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(gaps, pa.list_(pa.string())), pa.array(one, pa.list_(pa.int64())), pa.array(two, pa.list_(pa.int64()))], ["doc_id", "key", "gaps", "h1s", "h2s"])

    places = waiting.mapInArrow(bodies, "doc_id long, key long, h1 long, h2 long, body string")
    once = places.groupBy("h1", "h2").agg(F.first("body").alias("body")).mapInArrow(code, "h1 long, h2 long, code binary")
    each = places.select("doc_id", "key", "h1", "h2").distinct().join(once, ["h1", "h2"]).groupBy("doc_id", "key").agg(F.collect_list(F.struct("h1", "h2", "code")).alias("codes"))
    each = each.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), "codes")
    parts = waiting.mapInArrow(rests, "doc_id long, key long, gaps array<string>, h1s array<long>, h2s array<long>")
    whole = parts.join(each, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k")), "left").select("doc_id", "key", "gaps", "h1s", "h2s", "codes")

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, table = load(path)
        for b in batches:
            for r in range(len(b)):
                doc_id, gaps, h1s, h2s, codes = (b.column(n)[r].as_py() for n in ("doc_id", "gaps", "h1s", "h2s", "codes"))
                have = {(c["h1"], c["h2"]): np.frombuffer(c["code"], _width(table)).astype(np.uint32) for c in codes or ()}
                ids = repaired(gaps, [have[x] for x in zip(h1s, h2s, strict=True)], path)
                raw = b"".join([table[t] for t in ids.tolist()])
                if np.uint64(xxhash.xxh3_64_intdigest(raw)).astype(np.int64) != b.column("key")[r].as_py():
                    raise ValueError(f"the ids of document {doc_id} are not those of its text")
                yield _out([doc_id], [ids], table, digest)

    return done.unionAll(whole.mapInArrow(repair, DIGESTS if digest else CODES))


def op3_bpe_codec(spark, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)

"""SentencePiece encoding and decoding over a table of distinct chunks.

Where no piece of the model holds a white-space marker after another character, no merge
crosses from one marked word to the next. Texts are therefore cut into chunks (markers
and what follows them), the distinct chunks of all texts form one table, each is segmented
once, and the ids go back to the places of their chunk.

Texts are cut in batches. A batch lists its distinct chunks once, by bucket of their hash,
and each text becomes numbers into that list. All lists of a bucket meet in one task, where every
distinct chunk is segmented once; each list goes back to its batch as ids in the same order.
Lists, numbers and ids travel compressed.
"""

from __future__ import annotations

import codecs
import re
import uuid
import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import ArrayType, StructField, StructType

from ..session import cut_lineage, release, shuffles_freed, write_work
from .batches import cut, ddl, without

MARK = "▁"
BATCH_BYTES, SLICE_BYTES, BUCKET_BYTES, MOST_BUCKETS, MEMO = 8_000_000, 1_000_000, 16_000_000, 4096, 2_000_000
SHORT, NEVER = 48, float("-inf")
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


@dataclass
class Pieces:
    """Ids and merge scores of pieces, ids of bytes, bytes of ids."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    surfaces: list[bytes]
    raw: np.ndarray  # whether an id stands for a single byte
    unknown: int

    @classmethod
    def read(cls, path: str) -> Pieces:
        """A BPE model with byte fallback, identity normaliser and a leading marker; others are refused."""
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        n = library.get_piece_size()
        names = [library.id_to_piece(i) for i in range(n)]
        special = [library.is_control(i) or library.is_unknown(i) or library.is_byte(i) for i in range(n)]
        plain = [i for i in range(n) if not special[i]]
        byte_ids = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        surfaces = [
            b"" if library.is_control(i) else bytes([int(names[i][3:5], 16)]) if library.is_byte(i)
            else " ⁇ ".encode() if library.is_unknown(i) else names[i].replace(MARK, " ").encode()
            for i in range(n)
        ]
        if any(library.is_unused(i) for i in plain) or not all(library.is_byte(i) for i in byte_ids):
            raise ValueError(f"{path}: unused pieces or no byte fallback")
        if any(re.search(f"[^{MARK}]{MARK}", names[i]) for i in plain):
            raise ValueError(f"{path}: a piece crosses a white-space marker")
        model = cls(
            {names[i]: i for i in plain}, {names[i]: library.get_score(i) for i in plain}, byte_ids, surfaces,
            np.array([library.is_byte(i) for i in range(n)]), library.unk_id(),
        )
        for probe in ("a  b", " ﬁ Á\t", "▁x \x00 \U0001f9ff"):
            if model.encode(probe) != library.encode(probe):
                raise ValueError(f"{path}: not a BPE model with identity normaliser and leading marker")
        return model

    def encode(self, text: str) -> list[int]:
        return [i for chunk in chunks(text) for i in self.segment(chunk)]

    def segment(self, chunk: str) -> list[int]:
        """Ids of one chunk: the pair with the greatest score is merged first, the left one of equals."""
        parts = list(chunk if chunk.startswith(MARK) else MARK + chunk)
        merged = self._short(parts) if len(parts) <= SHORT else self._long(parts)
        out: list[int] = []
        for part in merged:
            found = self.ids.get(part)
            if found is None:
                out += [self.byte_ids[b] for b in part.encode("utf-8", "surrogatepass")]
            else:
                out.append(found)
        return out

    def _short(self, parts: list[str]) -> list[str]:
        """Merging by a scan of all pairs for the best one."""
        score = self.scores.get
        pairs = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while pairs and (best := max(pairs)) > NEVER:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], NEVER)
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], NEVER)
        return parts

    def _long(self, parts: list[str]) -> list[str]:
        """Merging by a queue of pairs."""
        scores, n = self.scores, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(-s, i, 2) for i in range(n - 1) if (s := scores.get(parts[i] + parts[i + 1])) is not None]
        heapify(heap)
        while heap:
            _, i, size = heappop(heap)
            j = after[i]
            if not parts[i] or j >= n or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i] += parts[j]
            parts[j] = ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (s := scores.get(parts[i] + parts[k])) is not None:
                    heappush(heap, (-s, i, len(parts[i]) + len(parts[k])))
            h = before[i]
            if h >= 0 and (s := scores.get(parts[h] + parts[i])) is not None:
                heappush(heap, (-s, h, len(parts[h]) + len(parts[i])))
        return [part for part in parts if part]

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: markers are spaces but for a leading one, bytes that are no UTF-8 a replacement each."""
        surfaces = [self.surfaces[i] for i in ids]
        if b"" in surfaces:  # control ids end a row of bytes
            spans = [list(own) for shown, own in groupby(surfaces, bool) if shown]
        else:
            spans = [surfaces]
        text = "".join([b"".join(own).decode("utf-8", "each_byte") for own in spans])
        first = next((i for i in ids if self.surfaces[i]), self.unknown)
        return text[1:] if text.startswith(" ") and not self.raw[first] and first != self.unknown else text


def chunks(text: str) -> list[str]:
    """Chunks of a text in order: markers and what follows them; a single marker is left out, so no chunk has a space."""
    if not text:
        return []
    words = text.split(" ")
    if MARK not in text and "" not in words:
        return words
    found = _CHUNK.findall(MARK + text.replace(" ", MARK))
    return [c if c.startswith(MARK, 1) else c[1:] for c in found]


codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces.read(path)


class _Codes(dict):
    def __missing__(self, chunk: str) -> int:
        self[chunk] = n = len(self)
        return n


def _packed_codes(codes: np.ndarray) -> bytes:
    """Numbers below 2 ** 32, the low bytes of all first, compressed."""
    planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpacked_codes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class _Batch:
    """Texts of one batch: slices of kept rows with their codes, and the distinct chunks."""

    def __init__(self):
        self.numbers, self.slices, self.size = _Codes(), [], 0

    def add(self, kept: pa.Array, texts: list) -> None:
        numbers = self.numbers
        found = [[numbers[c] for c in chunks(t)] if t else [] for t in texts]
        sizes = np.array([len(f) for f in found], np.int32)
        self.slices.append((kept, sizes, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))))
        self.size += sum(len(t or "") for t in texts)

    def rows(self, buckets: int):
        """(kind, bucket, n, data, sizes, kept): a sorted list of chunks for each bucket, then the slices; codes follow the order of the lists."""
        lists: list[list] = [[] for _ in range(buckets)]
        for chunk in self.numbers:
            lists[zlib.crc32(chunk.encode("utf-8", "surrogatepass")) % buckets].append(chunk)
        press, place, at = zstandard.ZstdCompressor(level=3), np.empty(len(self.numbers), np.uint32), 0
        for bucket, own in enumerate(lists):
            if own:
                own.sort()
                place[[self.numbers[c] for c in own]] = np.arange(at, at + len(own), dtype=np.uint32)
                at += len(own)
                yield 0, bucket, len(own), press.compress(" ".join(own).encode("utf-8", "surrogatepass")), None, None
        for kept, sizes, codes in self.slices:
            yield 1, buckets, len(sizes), _packed_codes(place[codes]) if len(codes) else b"", sizes, kept


def _listed(data: bytes) -> list[str]:
    """Chunks of a list; a chunk has no space."""
    return zstandard.ZstdDecompressor().decompress(data).decode("utf-8", "surrogatepass").split(" ")


def _as_batches(docs: DataFrame, path: str, text: str, kept: list[str], buckets: int, batch_bytes: int) -> DataFrame:
    source = docs.select(F.struct(*[docs[c] for c in kept]).alias("__kept"), docs[text].alias("__text"))
    row = source.schema["__kept"].dataType
    schema = StructType([
        *ddl("kind int, batch bigint, bucket int, n int, data binary, sizes array<int>").fields,
        StructField("kept", ArrayType(row)),
    ])
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(parts):
        pieces(path)  # an unfit model is refused before any work
        batch, made = _Batch(), TaskContext.get().partitionId() << 32

        def flushed():
            for kind, bucket, n, data, sizes, rows in batch.rows(buckets):
                lists = pa.nulls(1, kinds[6]) if rows is None else pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows).cast(kinds[6])
                yield pa.RecordBatch.from_arrays([
                    pa.array([kind], kinds[0]), pa.array([made], kinds[1]), pa.array([bucket], kinds[2]), pa.array([n], kinds[3]),
                    pa.array([data], kinds[4]), pa.array([None if sizes is None else sizes], kinds[5]), lists,
                ], names=schema.names)

        for whole in parts:
            for part in cut(whole, 1, min(SLICE_BYTES, batch_bytes)):
                batch.add(part.column(0), part.column(1).to_pylist())
                if batch.size >= batch_bytes:
                    yield from flushed()
                    batch, made = _Batch(), made + 1
        if batch.slices:
            yield from flushed()

    return source.mapInArrow(run, schema)


def _segmented(lists: DataFrame, path: str, buckets: int) -> DataFrame:
    """(batch, bucket, data): the ids of each list, every distinct chunk of a bucket segmented once."""

    def run(parts):
        model, at, known = pieces(path), None, {}
        press = zstandard.ZstdCompressor(level=3)
        for part in parts:
            out = []
            for bucket, data in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                if bucket != at or len(known) > MEMO:
                    at, known = bucket, {}
                own = _listed(data)
                for c in own:
                    if c not in known:
                        known[c] = model.segment(c)
                ids = [known[c] for c in own]
                sizes = np.array([len(i) for i in ids], "<u4")
                flat = np.fromiter(chain.from_iterable(ids), "<u4", int(sizes.sum()))
                out.append(len(own).to_bytes(4, "little") + press.compress(sizes.tobytes() + _narrow(flat, model)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.binary())], names=["batch", "bucket", "data"])

    met = lists.select("batch", "bucket", "data").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(run, "batch bigint, bucket int, data binary")


def _narrow(ids: np.ndarray, model: Pieces) -> bytes:
    return ids.astype("<u2" if len(model.surfaces) <= 1 << 16 else "<u4").tobytes()


def _told(data: bytes, model: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and ids of a list that ``_segmented`` wrote."""
    n, plain = int.from_bytes(data[:4], "little"), zstandard.ZstdDecompressor().decompress(data[4:])
    kind = "<u2" if len(model.surfaces) <= 1 << 16 else "<u4"
    return np.frombuffer(plain, "<u4", n).astype(np.int64), np.frombuffer(plain, kind, offset=4 * n).astype(np.int32)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places ``start .. start + size - 1`` of each pair in a row."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def encode_texts(
    docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Adds ``token_ids`` (array of int) and ``n_tokens``, equal to the library's without begin and end ids.

    Null and empty texts have no tokens; repeated rows get the same ids; columns called
    like the new ones are replaced; an empty table stays empty. Batches hold ``batch_bytes``
    of text (or one longer text). The cut texts are written once to the shared folder, so that
    a lost task finds the same batches. A very common chunk is there once per batch, and
    buckets are as many as the text has 16 MB, up to 4096; a bucket of over two
    million distinct chunks starts its table anew.
    """
    spark = docs.sparkSession
    kept = without(docs.select(*keep) if keep is not None else docs, ["token_ids", "n_tokens"])
    total = docs.agg(F.sum(F.octet_length(docs[text]).cast("bigint"))).first()[0] or 0
    buckets = max(16, min(MOST_BUCKETS, total // BUCKET_BYTES))
    rows = _as_batches(docs, path, text, kept, buckets, batch_bytes)
    name = f"chunk_codes_{uuid.uuid4().hex[:12]}"
    folder = write_work(rows, name, "kind", (max(1, min(MOST_BUCKETS, -(-total // batch_bytes))), "batch"))
    if total:
        listed = spark.read.schema(rows.drop("kind").schema).parquet(f"{folder}/kind=0")
        with shuffles_freed(spark):
            lists = cut_lineage(_segmented(listed, path, buckets))
        release(listed)
    else:  # no text: no list was written
        lists = spark.createDataFrame([], "batch bigint, bucket int, data binary")
    coded = spark.table(name).where("kind = 1").select("batch", "data", "sizes", "kept")
    out = StructType([*rows.schema["kept"].dataType.elementType.fields, *ddl("token_ids array<int>, n_tokens bigint").fields])
    arrow = to_arrow_schema(out)

    def run(slices: pa.Table, own: pa.Table) -> pa.Table:
        model = pieces(path)
        told = [_told(data, model) for _, data in sorted(zip(own.column("bucket").to_pylist(), own.column("data").to_pylist()))]
        lengths = np.concatenate([*[size for size, _ in told], np.zeros(0, np.int64)])
        flat = np.concatenate([*[ids for _, ids in told], np.zeros(0, np.int32)])
        starts, made = np.cumsum(lengths) - lengths, []
        for data, words, rows_ in zip(slices.column("data").to_pylist(), slices.column("sizes"), slices.column("kept")):
            codes = _unpacked_codes(data) if data else np.zeros(0, np.int64)
            upto = np.concatenate([[0], np.cumsum(lengths[codes])])
            cuts = upto[np.concatenate([[0], np.cumsum(words.values.to_numpy())])]
            ids = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat[_spread(starts[codes], lengths[codes])]))
            made.append(pa.Table.from_arrays([*rows_.values.flatten(), ids, pa.array(np.diff(cuts))], names=arrow.names))
        return pa.concat_tables(made).cast(arrow) if made else arrow.empty_table()

    return coded.groupBy("batch").cogroup(lists.groupBy("batch")).applyInArrow(run, out)


def decode_ids(encoded: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """Adds ``decoded``, the library's text of the ids; null and no ids give an empty text, ids out of range an error."""
    kept = without(encoded, ["decoded"])
    source = encoded.select(*kept) if ids in kept else encoded
    schema = StructType([*source.schema.fields, *ddl("decoded string").fields])
    place = source.columns.index(ids)

    def run(parts):
        model = pieces(path)
        for part in parts:
            column = part.column(place)
            flat, ends = column.flatten().to_numpy(), np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())
            texts, start = [], 0
            for end in ends.tolist():  # one text at a time: a batch of ids as Python numbers is ten times as large
                texts.append(model.decode(flat[start:end].tolist()))
                start = end
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return source.mapInArrow(run, schema)

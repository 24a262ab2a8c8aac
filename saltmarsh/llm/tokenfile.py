"""Token-id output: documents' ids as Simple-8b words in files in ascending order of document ids.

Documents are dealt by range of (id, text hash), sorted, encoded and packed; each partition writes files that
roll at `ROLL_IDS` ids. A file is a run of segments, each whole documents:

    magic "SM8B0001", then documents, ids, words, blocks (unsigned 64-bit each)
    document ids (signed 64-bit), null flags (bytes), ids per document (unsigned 64-bit)
    first word of each block and the number of words (unsigned 32-bit)
    words (unsigned 64-bit)

all little-endian. A block can be decoded by itself, and a segment's blocks are decoded side by side. Files are
written under temporary names and renamed; the manifest (one row a file) lists them in order
with the ids before each. A task that is run again writes the same bytes under the same names.

A word's ids do not depend on its neighbours, as the tokenizer splits at white space; so each
distinct word is encoded once by the library and looked up from then on (a table of bounded size). Files of
other tokenizers, whose settings do not promise this, encode whole texts.

Nulls: a null text counts as empty (its ids are the end id only), null document ids come first. Documents
with equal ids are ordered by text hash; repeated rows are written as often as they come. Very long texts
are encoded whole. An empty table gives no files and an empty result.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import chunks, scratch_path, ship_package, stored, text_or_empty
from .remote import Committed, at
from .simple8b import pack, unpack

MAGIC = b"SM8B0001"
SEGMENT_IDS, ROLL_IDS, CACHED_WORDS, JOINED_WORDS, CHUNK_BYTES = 1 << 20, 1 << 26, 600_000, 2000, 2 << 20
# ASCII punctuation that the tokenizer never joins to letters before it (the apostrophe is not among it)
PUNCTUATION = ".,;:!?*#$%&|-_()[]{}<>=+/\\\"^~`@"

# Settings of a tokenizers file with which a text's ids are those of its words one after another
WORD_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORD_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
WORD_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def splits_by_words(settings: dict) -> bool:
    """Whether a tokenizers file has the settings that `WordIds` needs to look words up one by one."""
    pre = settings.get("pre_tokenizer") or {}
    plain = settings.get("normalizer") == WORD_NORMALIZER and pre.get("pretokenizers") == [WORD_SPLIT, WORD_BYTES]
    return plain and settings["model"].get("end_of_word_suffix") == "</w>" and not any(re.search(r"\s", t["content"]) for t in settings.get("added_tokens", []))


def joined(flat: np.ndarray, size: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The pieces of `flat` (of these sizes, one after another) that are chosen, in their order."""
    begin, n = (np.cumsum(size) - size)[chosen], size[chosen]
    ends = np.cumsum(n)
    return flat[np.repeat(begin - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]


class WordIds:
    """A tokenizers file's ids of whole texts, as little-endian unsigned 32-bit integers.

    With a file of other settings than `splits_by_words` knows, whole texts are encoded by the library. Else texts are split at ASCII white space; a batch's distinct words are looked up, and those not yet known encoded
    by the library. A word of letters with ASCII punctuation behind it is looked up and encoded as these two parts, which
    the tokenizer's own splitting keeps apart, the letters in lower case, as its normaliser makes them; so fewer words
    are new, and only the parts are kept.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are parallel already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.by_word = splits_by_words(json.load(f))
        self.known: dict[str, bytes] = {"": b""}
        vocabulary = self.tokenizer.get_vocab()
        self.ending = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ending[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _learn(self, words: list[str]) -> None:
        """Ids of new words. Words of letters are joined by blanks into long texts, whose ids are cut after the tokens that end a word."""
        plain = [w for w in words if w.isalpha() and "İ" not in w]
        rest = [w for w in words if not w.isalpha() or "İ" in w]
        texts = [plain[i : i + JOINED_WORDS] for i in range(0, len(plain), JOINED_WORDS)]
        for part in texts:  # one by one: what the library makes of a text is many times its size
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ending[ids]) + 1
            if len(ends) != len(part):
                rest += part
                continue
            data, cuts = ids.tobytes(), (4 * ends).tolist()
            self.known.update(zip(part, [data[x:y] for x, y in zip([0, *cuts[:-1]], cuts, strict=True)], strict=True))
        if rest:
            for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
                self.known[w] = np.array(e.ids, "<u4").tobytes()

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of each of some distinct words."""
        if len(self.known) > CACHED_WORDS:
            self.known = {"": b""}
        known = self.known
        found = list(map(known.get, words))
        missing = [w for w, x in zip(words, found, strict=True) if x is None]
        if missing:
            cased = [(w, low) for w, low in zip(missing, map(str.lower, missing), strict=True) if low != w and w.isalpha() and "İ" not in w and "Σ" not in w]  # these two are not lowered letter by letter
            new = dict.fromkeys(missing)
            for w, low in cased:
                del new[w]
            new.update(dict.fromkeys(low for _, low in cased))
            self._learn([w for w in new if w not in known])
            for w, low in cased:
                known[w] = known[low]
            found = list(map(known.__getitem__, words))
        return found

    def parts(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some distinct words, and how many each has. Punctuation behind letters is looked up by itself, so that words differ less."""
        trimmed = pc.utf8_rtrim(words, characters=PUNCTUATION).dictionary_encode()
        letters = trimmed.dictionary.to_numpy(zero_copy_only=False).tolist()
        apart = np.fromiter(map(str.isalpha, letters), bool, len(letters))
        for odd in "İΣ":
            apart &= ~pc.match_substring(trimmed.dictionary, odd).to_numpy(zero_copy_only=False)
        code = trimmed.indices.to_numpy(zero_copy_only=False)
        ends = pc.subtract(pc.binary_length(words), pc.binary_length(trimmed.dictionary).take(trimmed.indices)).to_numpy(zero_copy_only=False)
        ends = np.where(apart[code], ends, 0)
        behind = np.flatnonzero(ends)
        behind_text = [w[-n:] for w, n in zip(words.take(pa.array(behind)).to_numpy(zero_copy_only=False).tolist(), ends[behind].tolist(), strict=True)]
        number = {x: i for i, x in enumerate(dict.fromkeys(behind_text))}
        other = np.flatnonzero(~apart[code])
        alone = np.flatnonzero(apart)
        # first and second part of each word, as places among the parts
        all_parts = ["", *number, *[letters[i] for i in alone.tolist()], *words.take(pa.array(other)).to_numpy(zero_copy_only=False).tolist()]
        place = np.zeros(len(letters), np.int64)
        place[alone] = 1 + len(number) + np.arange(len(alone))
        both = np.zeros((len(words), 2), np.int64)
        both[:, 0] = place[code]
        both[other, 0] = len(all_parts) - len(other) + np.arange(len(other))
        both[behind, 1] = 1 + np.fromiter(map(number.__getitem__, behind_text), np.int64, len(behind))
        ids = self.words(all_parts)
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        return joined(flat, size, both.reshape(-1)), size[both].sum(axis=1)

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text's begin (one more than texts)."""
        if not self.by_word:
            found = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(pc.fill_null(texts, "").to_pylist(), add_special_tokens=False)]
            return np.concatenate([np.zeros(0, "<u4"), *found]), np.cumsum([0, *map(len, found)])
        parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = parts.flatten().dictionary_encode()
        flat, size = self.parts(coded.dictionary)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        out, ends = joined(flat, size, codes), np.cumsum(size[codes])
        cuts = np.concatenate(([0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))))
        return out, np.concatenate(([0], ends))[cuts]


@lru_cache(maxsize=1)
def encoder_of(path: str) -> WordIds:
    """One encoder a worker, so that its words outlive a task."""
    return WordIds(path)


def segment(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """One segment of whole documents."""
    values = np.concatenate(ids)
    words, offsets = pack(values)
    head = struct.pack("<QQQQ", len(ids), len(values), len(words), len(offsets) - 1)
    return b"".join((MAGIC, head, np.array([x or 0 for x in doc_ids], "<i8").tobytes(), bytes(x is None for x in doc_ids), np.array([len(x) for x in ids], "<u8").tobytes(), offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes()))


def segments(stream) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Document ids, ids per document and all ids, segment by segment."""
    while head := stream.read(len(MAGIC) + 32):
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError("not a segment of token ids")
        docs, n, words, blocks = struct.unpack("<QQQQ", head[len(MAGIC) :])
        doc_ids = np.frombuffer(stream.read(8 * docs), "<i8").tolist()
        missing = stream.read(docs)
        sizes = np.frombuffer(stream.read(8 * docs), "<u8").astype(np.int64)
        offsets = np.frombuffer(stream.read(4 * (blocks + 1)), "<u4").astype(np.int64)
        values = unpack(np.frombuffer(stream.read(8 * words), "<u8"), offsets, n)
        yield [None if m else d for d, m in zip(doc_ids, missing, strict=True)], sizes, values


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the files below `folder` (a URI all executors reach); the manifest: path, part, documents, ids, first_id, bytes."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).alias("body"))
    tie = F.xxhash64("body")
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie, "body")
    ending = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        part, attempt, encoder, made = task.partitionId(), str(task.taskAttemptId()), encoder_of(tokenizer), []
        out, held, doc_ids, ids = None, 0, [], []

        def flush() -> None:
            nonlocal held
            out.write(segment(doc_ids, ids))
            made[-1][2] += len(ids)
            made[-1][3] += held
            doc_ids.clear()
            ids.clear()
            held = 0

        for batch in batches:
            for piece in chunks(batch, "body", CHUNK_BYTES):
                all_ids, cuts = encoder.of(piece.column("body"))
                for d, a, b in zip(piece.column("doc_id").to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    if out is None:
                        path = f"{folder}/part-{part:06d}-{len(made):05d}.s8b"
                        out = Committed(path, attempt)
                        made.append([path, part, 0, 0, 0])
                    doc_ids.append(d)
                    ids += [np.append(all_ids[a:b], ending)]
                    held += b - a + 1
                    if held >= SEGMENT_IDS:
                        flush()
                        if made[-1][3] >= ROLL_IDS:
                            out.close()
                            made[-1][4], out = out.size, None
        if out is not None:
            if ids:
                flush()
            out.close()
            made[-1][4] = out.size
        for row in made:
            yield pa.RecordBatch.from_pydict({k: [v] for k, v in zip(("path", "part", "documents", "ids", "bytes"), row, strict=True)})

    manifest = stored(rows.mapInArrow(run, "path string, part long, documents long, ids long, bytes long"), "token-manifest")
    earlier = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return stored(manifest.withColumn("first_id", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).cast("long")), "token-files")


def read_token_files(spark: SparkSession, manifest: DataFrame, ids: bool = True) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32, and the ids (array of longs) unless told otherwise."""
    ship_package(spark)
    files = manifest.select("path", "first_id").repartition(max(1, manifest.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("first_id").to_pylist(), strict=True):
                where, name = at(path)
                with where.open_input_stream(name, compression=None) as stream:
                    for doc_ids, sizes, values in segments(stream):
                        cuts = np.concatenate(([0], np.cumsum(sizes)))
                        data = memoryview(values.astype("<u4").tobytes())
                        crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                        columns = [pa.array(doc_ids, pa.int64()), pa.array(start + cuts[:-1]), pa.array(sizes), pa.array(crc, pa.int64())]
                        if ids:
                            columns.append(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values.astype(np.int64))))
                        start += int(cuts[-1])
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids)


def token_digest(docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Writes all documents and reads the files back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    manifest = write_token_files(docs, folder or scratch_path(spark, "tokens"), tokenizer, end_id)
    return read_token_files(spark, manifest, ids=False)

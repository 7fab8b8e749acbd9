"""Packing tokenised documents into sequences of fixed length.

Documents are tokenised once, in place; only lean rows (id, piece, length,
checksum) are shuffled.  They are dealt over partitions of about
``PART_ROWS`` pieces and packed there by best-fit decreasing.  Dual feasible
functions give a lower bound of the bins that a partition's pieces need.  A
partition that reaches its bound is certified and done; so are its full bins
elsewhere.  The other pieces of partitions with a gap are exchanged: dealt
anew together and packed again, until that saves no sequence.  Rows are dealt by
their number, so repeated rows do not meet in one task.

Defined results: null and empty texts are the end id alone; a document longer
than a sequence is cut into whole sequences and a rest; repeated rows are
packed each; a null doc_id is kept; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import zlib
from itertools import count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import map_rows, table, worker_cache
from textmill.session import written

SEQUENCE = 4096
END_ID = 1
PART_ROWS = 20_000
CACHED = 400_000
TOKENIZER = "word_bpe_49k.json"
#: One pre-token of the vocabulary's own splitting rule (fixed by its file).
_PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPECIAL = ("<|startoftext|>", "<|endoftext|>")


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write bytes that have no visible Latin-1 letter
    as the letters from U+0100 on, in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds:
    """Token ids of texts, as little-endian bytes, by way of their words.

    Tokens never cross white space here, so each different word is tokenised
    once and kept, up to ``limit`` of them, then the table starts anew.  Texts
    with special tokens or separator controls, and words beyond Latin-1, go
    through the tokenizer whole.
    """

    def __init__(self, path: str, limit: int = CACHED):
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.tokens = self.whole.model.tokenize
        self.letters = _byte_letters()
        self.pretokens = regex.compile(_PRETOKEN).findall
        self.odd = regex.compile("[\x1c-\x1f]|" + "|".join(map(regex.escape, _SPECIAL))).search
        self.known: dict[str, bytes] = {}
        self.limit = limit

    def _slow(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        ids = self.known.get(part)
        if ids is None:
            letters = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(self.letters)
            ids = self.known[part] = b"".join([t.id.to_bytes(4, "little") for t in self.tokens(letters)])
        return ids

    def _word(self, word: str) -> bytes:
        """Ids of one lower-case Latin-1 word."""
        if word.isalpha():
            return self._part(word)
        if word[-1] in ".," and word[:-1].isalpha():
            ids = self._part(word[:-1]) + self._part(word[-1])
        else:
            ids = b"".join(map(self._part, self.pretokens(word)))
        self.known[word] = ids
        return ids

    def _wide_word(self, word: str) -> bytes:
        ids = self.known.get("\n" + word)  # its own name space: not lower-cased yet
        if ids is None:
            ids = self.known["\n" + word] = self._slow(word)
        return ids

    def of(self, text: str) -> bytes:
        if self.odd(text):
            return self._slow(text)
        if len(self.known) > self.limit:
            self.known.clear()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return b"".join(map(self._wide_word, text.split()))
        words = text.lower().split()
        got = list(map(self.known.get, words))
        if None in got:
            got = [self._word(w) if g is None else g for g, w in zip(got, words)]
        return b"".join(got)


def pieces(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID,
           keep_ids: bool = False) -> DataFrame:
    """Documents as pieces of at most ``sequence`` ids: doc_id, piece, start,
    length, ids_crc32, and ``ids`` (little-endian bytes) if asked for.
    ``tokenizer`` is a path that every executor can open."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = end_id.to_bytes(4, "little")

    def run(batches):
        cache = worker_cache("word_ids")
        if tokenizer not in cache:
            cache[tokenizer] = WordIds(tokenizer)
        ids_of = cache[tokenizer].of
        for b in batches:
            out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            if keep_ids:
                out["ids"] = []
            for doc, text in zip(b["doc_id"], b["text"]):
                ids = ids_of(text or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * sequence)):
                    part = ids[at:at + 4 * sequence]
                    out["doc_id"].append(doc)
                    out["piece"].append(k)
                    out["start"].append(at // 4)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    if keep_ids:
                        out["ids"].append(part)
            yield out

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    return map_rows(docs.select("doc_id", "text"), run, schema)


def lower_bound(lengths, capacity: int) -> int:
    """The most bins that any of two families of dual feasible functions proves
    necessary for items of ``lengths``."""
    n = np.bincount(np.asarray(lengths, np.int64), minlength=capacity + 1)
    size = np.arange(capacity + 1)
    total = int((n * size).sum())
    best = -(-total // capacity)
    # Sizes above capacity - k count as whole bins, sizes below k as nothing.
    k = np.arange(1, capacity // 2 + 1)
    upto, mass = np.cumsum(n), np.cumsum(n * size)
    whole = upto[-1] - upto[capacity - k]
    middle = mass[capacity - k] - mass[k - 1]
    best = max(best, int((whole + -(-middle // capacity)).max(initial=0)))
    # Sizes rounded down to k-ths of the capacity, exact multiples of 1/(k+1) kept.
    for k in range(1, 41):
        exact = size * (k + 1) % capacity == 0
        scaled = np.where(exact, size * k, (k + 1) * size // capacity * capacity)
        best = max(best, -(-int((n * scaled).sum()) // (k * capacity)))
    return best


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Best-fit for lengths in decreasing order: (bin, offset) of each, and what
    each bin has left.  Bins are kept by the room they have left; one bit per
    room tells which are in use, so the tightest fit is one bit search."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, rooms, bins, offsets = 0, [], [], []
    for s in lengths:
        fits = used >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                used ^= 1 << room
        else:
            at, room = len(rooms), capacity
            rooms.append(capacity)
        bins.append(at)
        offsets.append(capacity - room)
        rooms[at] = room - s
        by_room[room - s].append(at)
        used |= 1 << (room - s)
    return bins, offsets, rooms


def _packed(open_pieces: DataFrame, rows: int, salt: int, capacity: int, part_rows: int) -> DataFrame:
    """One round: pieces dealt evenly by a hash and packed in each partition.
    ``open``: the partition has a gap to its bound and the bin has room."""
    names = open_pieces.columns
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in open_pieces.schema)

    def run(batches):
        from pyspark import TaskContext

        cols: dict[str, list] = {c: [] for c in names}
        for b in batches:
            for c in names:
                cols[c] += b[c]
        if not cols["length"]:
            return
        at = range(len(cols["length"]))
        order = sorted(at, key=lambda i: (-cols["length"][i], str(cols["doc_id"][i]), cols["piece"][i], cols["ids_crc32"][i]))
        lengths = [cols["length"][i] for i in order]
        bins, offsets, rooms = best_fit(lengths, capacity)
        gap = len(rooms) > lower_bound(lengths, capacity)
        first = (salt << 56) + (TaskContext.get().partitionId() << 32)
        for lo in range(0, len(order), 10_000):
            some = order[lo:lo + 10_000]
            yield {c: [cols[c][i] for i in some] for c in names} | {
                "sequence_id": [first + x for x in bins[lo:lo + 10_000]], "offset": offsets[lo:lo + 10_000],
                "open": [gap and rooms[x] > 0 for x in bins[lo:lo + 10_000]]}

    # ``open_pieces`` is a written table, so a row's number is the same in every try.
    dealt = (open_pieces.withColumn("_row", F.monotonically_increasing_id())
             .repartition(max(1, -(-rows // part_rows)), F.xxhash64(F.lit(salt), "_row")).drop("_row"))
    return map_rows(dealt, run, f"{fields}, sequence_id bigint, offset bigint, open boolean")


def pack(cut: DataFrame, capacity: int = SEQUENCE, part_rows: int = PART_ROWS) -> DataFrame:
    """``cut`` (doc_id, piece, length, ids_crc32, ...; a written table) with
    sequence_id and offset."""
    names = cut.columns
    done = None
    now = written(_packed(cut, cut.count(), 0, capacity, part_rows), "packed")
    for salt in count(1):  # every round but the last needs fewer sequences
        rest = now.filter("open")
        rows, bins = rest.agg(F.count("*"), F.countDistinct("sequence_id")).first()
        if not rows:
            break
        again = written(_packed(rest.select(*names), rows, salt, capacity, part_rows), "packed")
        if again.select("sequence_id").distinct().count() >= bins:
            break  # the exchange saved nothing: what was packed before stands
        kept = now.filter("not open")
        done = kept if done is None else done.unionByName(kept)
        now = again
    out = now if done is None else done.unionByName(now)
    return out.select(*names, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = SEQUENCE, end_id: int = END_ID,
                   keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, (ids), sequence_id, offset."""
    return pack(written(pieces(docs, tokenizer, capacity, end_id, keep_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the sequences themselves, from pieces with
    ``ids``.  A group is at most one sequence long."""
    group = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return group.select("sequence_id", "length", joined.alias("ids"))


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of an installed public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_pack_best_fit(spark, sf_dir):
    """All documents packed into sequences of 4096 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())

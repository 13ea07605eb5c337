"""Fill-in-middle transformation: texts cut at two token boundaries and rearranged.

A text's boundaries are the places before its units (words of ASCII letters, and every
other character for itself) and its end. They are held as a compressed set in the manner
of Roaring bitmaps: places are split by their upper bits into chunks of 65,536, each kept
as a sorted array, a bitmap or a list of runs, whichever is smallest, with the cumulative
number of places before each chunk. The place after k units is the k-th member of the set:
a search in the cumulative numbers finds the container, a local select the member.

Rearranging and its way back are ``fill_in_middle`` and ``restore``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

# Signs before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

PLAIN_PERCENT = 10  # of texts stay as they are
SPM_PERCENT = 20  # of the others begin with the suffix

CHUNK_BITS = 16
CHUNK = 1 << CHUNK_BITS
BITMAP_BYTES = CHUNK // 8
OUTPUT_BYTES = 4 << 20  # output rows of a batch are handed on at about so many bytes


class ArrayContainer:
    """Few members: their sorted lower bits."""

    def __init__(self, members: np.ndarray):
        self.members = members.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.members[k])


class BitmapContainer:
    """Many scattered members: one bit a place, and the members before each word."""

    def __init__(self, mask: np.ndarray):
        packed = np.packbits(mask, bitorder="little")
        self.words = np.zeros(-(-len(packed) // 8), np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, "right")) - 1
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return word * 64 + int(np.flatnonzero(bits)[k - self.before[word]])


class RunContainer:
    """Members in long runs: start of each run, and the members before it."""

    def __init__(self, starts: np.ndarray, ends: np.ndarray):
        self.starts = starts.astype(np.uint16)
        self.before = np.concatenate([[0], np.cumsum(ends - starts, dtype=np.int64)])

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])


Container = ArrayContainer | BitmapContainer | RunContainer


def container(mask: np.ndarray) -> tuple[Container, int]:
    """The smallest container of the true places of a chunk, and their number."""
    n = int(np.count_nonzero(mask))
    edges = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    runs = (len(edges) + int(mask[0]) + int(mask[-1])) // 2
    if 4 * runs <= min(2 * n, BITMAP_BYTES):
        edges = np.concatenate([[0]] * bool(mask[0]) + [edges] + [[len(mask)]] * bool(mask[-1]))
        return RunContainer(edges[::2], edges[1::2]), n
    if 2 * n <= BITMAP_BYTES:
        return ArrayContainer(np.flatnonzero(mask)), n
    return BitmapContainer(mask), n


class BoundarySet:
    """A set of places (64-bit) that knows its k-th member; ``len`` is its cardinality."""

    def __init__(self, mask: np.ndarray):
        """``mask`` is true at the members; chunks without any have no container."""
        self.keys, self.containers, sizes = [], [], []
        for key, at in enumerate(range(0, len(mask), CHUNK)):
            part = mask[at : at + CHUNK]
            if part.any():
                held, n = container(part)
                self.keys.append(key)
                self.containers.append(held)
                sizes.append(n)
        self.before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The k-th smallest member, counted from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, "right")) - 1
        local = self.containers[at].select(k - int(self.before[at]))
        return (self.keys[at] << CHUNK_BITS) + local


def boundaries(text: str) -> BoundarySet:
    """Places in ``text``, in code points, before each unit, and its end."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letter = ((points | np.uint32(0x20)) - np.uint32(0x61)) < np.uint32(26)
    mask = np.ones(len(points) + 1, bool)
    mask[1:-1] = ~(letter[1:] & letter[:-1])
    return BoundarySet(mask)


def rearranged(text: str, draws: tuple[int, int, int, int]) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, characters of prefix and of middle, output) of one text."""
    places = boundaries(text)
    n = len(places) - 1
    marked = PREFIX in text or SUFFIX in text or MIDDLE in text
    if not text or marked or draws[2] % 100 >= 100 - PLAIN_PERCENT:
        return n, "plain", None, None, text
    first, last = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    a, b = places.select(first), places.select(last)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < SPM_PERCENT:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


FIELDS = pa.schema(
    [
        ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()), ("output", pa.string()),
    ]
)


def _rearranged(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, draws in batches:
        parts, rows, size = [], [], 0
        numbers = np.asarray(draws.flatten()).reshape(-1, 4).tolist()
        for i in range(len(texts)):
            row = rearranged(texts[i].as_py() or "", numbers[i])
            rows.append(row)
            size += len(row[4])
            if size > OUTPUT_BYTES:  # Python strings of a batch are not all held beside its result
                parts.append(_struct(rows))
                rows, size = [], 0
        parts.append(_struct(rows))
        yield pa.concat_arrays(parts)


def _struct(rows: list[tuple]) -> pa.StructArray:
    columns = zip(*rows) if rows else [[] for _ in FIELDS]
    return pa.StructArray.from_arrays(
        [pa.array(values, field.type) for values, field in zip(columns, FIELDS)], names=FIELDS.names
    )


def draws(key: Column, seed: int = 1) -> Column:
    """Four numbers below 2**32 from a row's key: the first 32 digits of its seeded sha256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)])


def fill_in_middle(text: Column, key: Column, seed: int = 1) -> Column:
    """Struct (n, form, prefix_chars, middle_chars, output) of a text.

    ``n`` counts the text's units. ``form`` is ``psm``, ``spm`` or ``plain``; texts that are
    empty or hold one of the three signs are ``plain``, as is a tenth of the others, and have
    no cuts (null). A null text is empty, a null key is drawn for like an empty one. Rows with
    equal key and text get the same result.
    """
    schema = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return arrow_udf(_rearranged, schema)(text, draws(key, seed))


def restore(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` made ``output`` of.

    The signs cannot occur in the parts, and as they begin with ``<`` and have no other one,
    no part and sign together show one too early.
    """

    def cut(rest: Column, sign: str) -> tuple[Column, Column]:
        head = F.substring_index(rest, sign, 1)
        return head, F.substr(rest, F.length(head) + len(sign) + 1)

    def body(first: str) -> Column:
        return F.substr(output, F.lit(len(first) + 1))

    prefix, rest = cut(body(PREFIX), SUFFIX)
    suffix, middle = cut(rest, MIDDLE)
    psm = F.concat(prefix, middle, suffix)
    suffix, rest = cut(body(SUFFIX), PREFIX)
    prefix, middle = cut(rest, MIDDLE)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)

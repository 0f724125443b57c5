"""Repeated byte strings across documents, by sorting suffixes: shallow multikey quicksort, deep blind tries.

A window is LENGTH bytes of a text. Windows that can be equal are brought together by an anchor: the
position of the smallest hash of GRAM bytes inside the window, which depends on the window alone.
An anchor's stretch holds all windows that have it as theirs. Stretches with an anchor that no other
stretch shares are done; so are stretches that are equal as a whole, of which only the first counts.
What remains are different stretches of one anchor. Their windows are suffixes of the stretch from
each start; they are sorted, and of equal ones the first in the corpus is the one that stays. Equal
windows have their anchor at the same offset, so the sort starts from parts of one anchor and offset.
An anchor with MANY different stretches would be too much for one task: its windows are dealt by a
hash of their bytes, equal ones of a slice as one row, and sorted there.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import gather, kept, small_batches, text_bytes
from tidemark.llm.near_dedup import mixed

LENGTH = 100
GRAM = 32
SHALLOW = 4  # words of 8 bytes that are sorted by multikey quicksort before blind tries take over
BUCKET_BYTES = 8 << 20
BLOCK = 1 << 14  # grams hashed side by side: what is worked on stays in a core's cache
AT_ONCE = 1 << 18
JOINED = 1 << 16  # stretches of a batch among which equal ones become one row
STRETCHES_AT_ONCE = 4096
MANY = 4096  # different stretches of one anchor; windows of anchors with as many are dealt by their content
JUDGED_AT_ONCE = 1 << 16
COMPARED_AT_ONCE = 1 << 14
NO_ID = -(1 << 63)
POLY = 0x9E3779B97F4A7C15
POLY_INVERSE = pow(POLY, -1, 1 << 64)
SHORT_POLY = 0x9E3779B1
CODES = mixed(np.arange(256, dtype=np.uint64), 9)
SHORT_CODES = (mixed(np.arange(256, dtype=np.uint64), 3) >> np.uint64(32)).astype(np.uint32)


def _places(data: np.ndarray) -> np.ndarray:
    """For each window the position of the smallest hash of GRAM bytes in it, the first of equal ones."""
    span = LENGTH - GRAM + 1
    places = np.empty(max(0, len(data) - LENGTH + 1), np.int64)
    number = np.arange(BLOCK, dtype=np.uint32)
    for first in range(0, len(places), BLOCK - span + 1):
        value = np.take(SHORT_CODES, data[first : first + BLOCK + GRAM - 1])
        width, power = 1, SHORT_POLY
        while width < GRAM:
            value = value[:-width] * np.uint32(power) + value[width:]
            power, width = power * power % (1 << 32), 2 * width
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x85EBCA6B)
        key = (value & np.uint32(0xFFFF0000)) | number[: len(value)]
        width = 1
        while 2 * width <= span:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        rest = span - width
        key = np.minimum(key[: len(key) - rest], key[rest:]) if rest else key
        np.add(key & np.uint32(0xFFFF), first, out=places[first : first + len(key)], casting="unsafe")
    return places


class Stretches(NamedTuple):
    """Stretches of a slice: hashes of the anchor and of the content, text, first and last window, place of the anchor."""

    anchor: np.ndarray
    content: np.ndarray
    text: np.ndarray
    low: np.ndarray
    high: np.ndarray
    place: np.ndarray


def _found(data: np.ndarray, offsets: np.ndarray) -> Stretches:
    """All stretches of windows that lie within one text."""
    places = _places(data)
    sizes = np.diff(offsets)
    within = np.maximum(sizes - LENGTH + 1, 0)
    inside = np.repeat(np.tile([True, False], len(sizes)), np.stack([within, sizes - within], axis=1).ravel())[: len(places)]
    cut = np.ones(len(places), bool)
    cut[1:] = (places[1:] != places[:-1]) | (inside[1:] != inside[:-1])
    low = np.flatnonzero(cut)
    high = np.append(low[1:], len(places))[: len(low)] - 1
    real = inside[low]
    low, high = low[real], high[real]
    place = places[low]
    anchor, content = _hashes(data, place, low, high)
    return Stretches(anchor.view(np.int64), content.view(np.int64), np.searchsorted(offsets, low, side="right") - 1, low, high, place)


@functools.cache
def _slice_powers(base: int) -> np.ndarray:
    return np.cumprod(np.full(AT_ONCE + 1, base, np.uint64))


def _powers(base: int, count: int) -> np.ndarray:
    return _slice_powers(base)[:count] if count <= AT_ONCE + 1 else np.cumprod(np.full(count, base, np.uint64))


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place, as a view."""
    return np.ndarray(max(0, len(data) - 7), ">u8", data, strides=(1,))


def _hashes(data: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the GRAM bytes at each place, and of each stretch's bytes and where its anchor lies in it."""
    anchor, words = np.zeros(len(place), np.uint64), _words(data)
    for at in range(0, GRAM, 8):
        anchor = mixed(anchor * np.uint64(POLY) + words[place + at], 5)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(np.take(CODES, data) * _powers(POLY, len(data)), out=sums[1:])
    # a sum over some bytes, moved to a common power: multiply by the inverse power of their start
    inverse = _powers(POLY_INVERSE, len(data) + 1)
    end = high + LENGTH
    shape = ((place - low) << 20 | (end - low)).astype(np.uint64)
    return anchor, mixed(mixed((sums[end] - sums[low]) * inverse[low], 11) + shape, 12)


def multikey_sort(strings: np.ndarray) -> np.ndarray:
    """Rank of each row of bytes: ranks are in the rows' order, equal rows share one."""
    n, width = strings.shape
    return _suffix_ranks(np.ascontiguousarray(strings).ravel(), np.arange(n) * width, width, np.zeros(n, np.int64))


def _suffix_ranks(data: np.ndarray, starts: np.ndarray, width: int, parts: np.ndarray) -> np.ndarray:
    """Rank of the `width` bytes from each start: in the order of parts, in each in the order of bytes; equal ones share one.

    Multikey quicksort: each part is split three ways around a pivot, the median of three of its words
    of 8 bytes; rows equal to the pivot go on with their next word, to a depth of SHALLOW words. All
    parts are split side by side, and parts of one row are done. Parts that are then still of several
    different rows go through blind tries.
    """
    n = len(starts)
    rank = np.zeros(n, np.int64)
    if n < 2:
        return rank
    depths = min(SHALLOW, -(-width // 8))
    words = _words(np.concatenate([data, np.zeros(8, np.uint8)]))
    order = np.argsort(parts, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(parts[order]) != 0]))
    sizes = np.diff(np.append(first, n))
    rank[order] = np.repeat(first, sizes)
    live = order[np.repeat(sizes > 1, sizes)]  # rows, part by part, in any order of parts
    sizes = sizes[sizes > 1]
    depth = np.zeros(len(live), np.int64)  # the row's next word
    deep = [live[:0]]
    while len(live):
        first = np.cumsum(sizes) - sizes
        word = words[starts[live] + 8 * depth].astype(np.uint64)
        if width % 8 and depths * 8 > width:  # the last word reaches beyond the row
            word &= np.where(depth == depths - 1, np.uint64((1 << 64) - (1 << 8 * (8 - width % 8))), ~np.uint64(0))
        a, b, c = word[first], word[first + sizes // 2], word[first + sizes - 1]
        pivot = np.repeat(np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c)), sizes)
        less, more = word < pivot, word > pivot
        same = ~(less | more)
        n_less, n_more = (np.add.reduceat(side, first, dtype=np.int64) for side in (less, more))
        n_same = sizes - n_less - n_more
        rank[live[same]] += np.repeat(n_less, n_same)
        rank[live[more]] += np.repeat(n_less + n_same, n_more)
        split = []
        for side, counts, step in ((less, n_less, 0), (same, n_same, 1), (more, n_more, 0)):
            stays = counts > 1
            rows = np.flatnonzero(side)[np.repeat(stays, counts)]
            split.append((live[rows], depth[rows] + step, counts[stays]))
        rows, next_word, counts = split[1]
        full = next_word == depths
        deep.append(rows[full])
        split[1] = rows[~full], next_word[~full], counts[~full[np.cumsum(counts) - counts]]
        live, depth, sizes = map(np.concatenate, zip(*split))
    live = np.concatenate(deep)
    if len(live) and width > depths * 8:
        first = np.flatnonzero(np.concatenate([[True], np.diff(rank[live]) != 0]))
        sizes = np.diff(np.append(first, len(live)))
        lead = np.repeat(live[first], sizes)
        differs = np.zeros(len(live), bool)
        rests = np.lib.stride_tricks.sliding_window_view(data, width - depths * 8)
        for at in range(0, len(live), COMPARED_AT_ONCE):
            some = slice(at, at + COMPARED_AT_ONCE)
            differs[some] = (rests[starts[live[some]] + depths * 8] != rests[starts[lead[some]] + depths * 8]).any(axis=1)
        for k in np.flatnonzero(np.add.reduceat(differs, first, dtype=np.int64)):
            rows = live[first[k] : first[k] + sizes[k]]
            rank[rows] += np.array(blind_trie_ranks([data[starts[r] : starts[r] + width].tobytes() for r in rows]))
    return rank


def blind_trie_ranks(strings: list[bytes]) -> list[int]:
    """Ranks of strings of one length by a blind trie.

    A node keeps only the place at which its strings first differ and the byte that each branch has
    there. A string goes down blindly, is compared once with a string it arrives at, and splits the
    path where the two differ.
    """
    distinct = list(dict.fromkeys(strings))
    root: list | int = 0
    for number in range(1, len(distinct)):
        text = distinct[number]
        node = root
        while isinstance(node, list):
            branches = node[1]
            node = branches.get(text[node[0]], next(iter(branches.values())))
        other = distinct[node]
        differ = _first_difference(text, other)
        above, key, node = None, 0, root
        while isinstance(node, list) and node[0] < differ:
            above, key = node, text[node[0]]
            node = node[1][key]
        if isinstance(node, list) and node[0] == differ:
            node[1][text[differ]] = number
            continue
        split = [differ, {text[differ]: number, other[differ]: node}]
        if above is None:
            root = split
        else:
            above[1][key] = split
    order: list[int] = []
    waiting = [root]
    while waiting:
        node = waiting.pop()
        if isinstance(node, list):
            waiting += [node[1][b] for b in sorted(node[1], reverse=True)]
        else:
            order.append(node)
    place = {distinct[number]: at for at, number in enumerate(order)}
    return [place[s] for s in strings]


def _first_difference(left: bytes, right: bytes) -> int:
    low, high = 0, len(left)
    while low < high:  # the strings differ, and agree before `low`
        middle = (low + high) // 2
        if left[low : middle + 1] == right[low : middle + 1]:
            low = middle + 1
        else:
            high = middle
    return low


def _bucketed(docs: DataFrame, id: str, text: str) -> tuple[DataFrame, int]:
    """doc, twin (a hash of the text, which orders rows of one id), bucket, text; a bucket holds about BUCKET_BYTES."""
    read = docs.select(F.col(id).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = read.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    buckets = max(8, -(-int(total) // BUCKET_BYTES))
    bucket = F.pmod(F.xxhash64(F.coalesce("doc", F.lit(NO_ID)), F.lit(7)), F.lit(buckets)).cast("int")
    return read.select(F.coalesce("doc", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("twin"), bucket.alias("bucket"), "text"), buckets


def _stretches(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, Stretches]]:
    """Texts by slices: number of the first text, bytes, offsets, and the stretches with positions in these bytes."""
    first = 0
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    while first < len(texts):
        base = ends[first - 1] if first else 0
        upto = max(first + 1, int(np.searchsorted(ends, base + AT_ONCE, side="right")))
        data, offsets = text_bytes(texts.slice(first, upto - first))
        yield first, data, offsets, _found(data, offsets)
        first = upto


def _packed(found: Stretches, offsets: np.ndarray) -> np.ndarray:
    """Place of the anchor in its text, bytes of the stretch before it, windows after the first: in one number, in order of place."""
    return (found.place - offsets[found.text]) << 16 | (found.place - found.low) << 8 | (found.high - found.low)


def _code(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first.view(np.uint64) + mixed(second.view(np.uint64), 17), 18)


def _joined(rows: np.ndarray) -> pa.RecordBatch:
    """Of anchor, content, bucket, doc, twin, at: rows that agree in the first three become one, with the first place and their number."""
    code = _code(_code(rows[0], rows[1]).view(np.int64), rows[2])
    order = np.argsort(code)
    code = code[order]
    tied = np.zeros(len(order), bool)
    tied[1:] = code[1:] == code[:-1]
    tied[:-1] |= tied[1:]
    alone, again = rows[:, order[~tied]], rows[:, order[tied]]
    again = again[:, np.lexsort(again[::-1])]
    new = np.ones(again.shape[1], bool)
    new[1:] = (again[:3, 1:] != again[:3, :-1]).any(axis=0)
    n = np.diff(np.append(np.flatnonzero(new), len(new)))
    out = np.concatenate([alone, again[:, new]], axis=1)
    count = np.concatenate([np.ones(alone.shape[1], np.int64), n])
    return pa.RecordBatch.from_arrays([*map(pa.array, out[[0, 1, 3, 4, 5]]), pa.array(count)], SPREAD)


class Pairs:
    """Rows found by two numbers: by a hash of both, then compared."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second
        code = _code(first, second)
        self.order = np.argsort(code)
        self.code = code[self.order]

    def rows(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """A row with these numbers for each pair, or -1."""
        code = _code(first, second)
        at = np.searchsorted(self.code, code)
        out = np.full(len(code), -1)
        left = np.arange(len(code))
        while len(left):
            left = left[at[left] < len(self.code)]
            left = left[self.code[at[left]] == code[left]]
            row = self.order[at[left]]
            equal = (self.first[row] == first[left]) & (self.second[row] == second[left])
            out[left[equal]] = row[equal]
            left = left[~equal]
            at[left] += 1
        return out


def _by_key(batches: Iterator[pa.RecordBatch], key: str, most: int) -> Iterator[tuple[pd.DataFrame, bool]]:
    """Rows that come sorted by key, in frames that hold all rows of their keys.

    A key with more than `most` rows gets frames of its own, all but its last marked as going on.
    """
    waiting: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        rows += batch.num_rows
        if rows < most:
            continue
        table = pa.Table.from_batches(waiting)
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield table.slice(0, cut).to_pandas(), False
            waiting, rows = table.slice(cut).to_batches(), table.num_rows - cut
        else:
            yield table.to_pandas(), True
            waiting, rows = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting).to_pandas(), False


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is repeated: rows of anchors that occur more than once, with the first place of their content.

    `stretches` says how many different stretches the anchor has: one, few or MANY. An anchor whose
    rows don't fit into one frame has MANY as soon as there are two; until the second is seen, the
    row of the first is held back.
    """
    place = ["doc", "twin", "at"]
    anchor_before = content_before = first_before = held = None
    several = False
    for frame, goes_on in _by_key(batches, "anchor", JUDGED_AT_ONCE):
        anchor = frame["anchor"].to_numpy()
        changes = np.concatenate([[True], np.diff(anchor) != 0, [True]])
        alone = changes[:-1] & changes[1:] & (frame["n"].to_numpy() == 1)
        alone[0] = False
        frame = frame[~alone]
        anchor, content, n = (frame[c].to_numpy() for c in ("anchor", "content", "n"))
        continued = anchor_before is not None and anchor[0] == anchor_before
        if held is not None and not continued:
            yield _judged(held)
            held = None
        new_anchor = np.concatenate([[True], np.diff(anchor) != 0])
        new_content = new_anchor | np.concatenate([[True], np.diff(content) != 0])
        a, c = np.cumsum(new_anchor) - 1, np.cumsum(new_content) - 1
        contents = np.bincount(a[new_content])
        same = continued and content[0] == content_before
        several = continued and (several or not same) or contents[0] > 1
        spread = continued or goes_on
        stretches = np.where(contents > MANY, MANY, np.minimum(contents, 2))
        if spread:
            stretches[0] = MANY if several else 1
        out = frame[["bucket", "anchor", "content", *place]].copy()
        out[place] = frame[place].to_numpy()[np.flatnonzero(new_content)[c]]
        if same:
            out.loc[c == 0, place] = first_before
        out["stretches"] = stretches[a]
        out["is_first"] = new_content & ~(same & (np.arange(len(frame)) == 0))
        live = (out["stretches"].to_numpy() > 1) | (np.bincount(c, n)[c] > 1)
        if spread:
            live |= a == 0
        if held is not None and several:
            yield _judged(held.assign(stretches=MANY))
            held = None
        if goes_on:
            anchor_before, content_before, first_before = anchor[-1], content[-1], out[place].to_numpy()[-1]
            if not several and not continued:
                held, live[0] = out.iloc[:1], False
        else:
            anchor_before = None
        yield _judged(out[live])
    if held is not None:
        yield _judged(held)


def _judged(rows: pd.DataFrame) -> pa.RecordBatch:
    return pa.RecordBatch.from_pandas(rows, schema=JUDGED, preserve_index=False)


JUDGED = pa.schema([(c, pa.int32() if c == "bucket" else pa.int64()) for c in ("bucket", "anchor", "content", "doc", "twin", "at", "stretches")] + [("is_first", pa.bool_())])


def _windows(stretches: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the stretches; of all their windows the start in these, the stretch and the offset there."""
    stretches = stretches.cast(pa.large_binary())
    _, offsets, data = stretches.buffers()
    offsets = np.frombuffer(offsets, np.int64)[stretches.offset : stretches.offset + len(stretches) + 1]
    data, offsets = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]
    count = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    owner = np.repeat(np.arange(len(count)), count)
    starts = gather(offsets[:-1], count)
    return data, starts, owner, starts - offsets[owner]


def _ranked(data: np.ndarray, starts: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Ranks of windows, which are equal only within a group; equal ones have their smallest hash at the same offset."""
    return _suffix_ranks(data, starts, LENGTH, groups * LENGTH + _places(data)[starts] - starts)


def _bytes_at(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(data, LENGTH)[starts]


def _window_keys(windows: np.ndarray) -> np.ndarray:
    key = np.zeros(len(windows), np.uint64)
    for word in np.ascontiguousarray(windows[:, : LENGTH // 4 * 4]).view("<u4").T:
        key = mixed(key * np.uint64(POLY) + word, 13)
    return key.view(np.int64)


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings to sort, with a key under which equal windows meet, and the stretches and offsets they stand for.

    A stretch of an anchor with few stretches stays whole, under its anchor. For anchors with MANY,
    which are too much for one task, every window goes under a key of its own bytes; those that are
    equal within a slice of rows become one row, the first place in front.
    """
    for batch in batches:
        column = lambda name: batch.column(batch.schema.get_field_index(name))
        many = pc.equal(column("stretches"), MANY)
        place = pc.subtract(column("at"), column("before"))
        every = pa.RecordBatch.from_arrays([column("anchor"), column("content"), column("doc"), column("twin"), place, column("stretch")], ["anchor", "content", "doc", "twin", "start", "string"])
        few = every.filter(pc.invert(many))
        if few.num_rows:
            one = pa.array(np.arange(few.num_rows + 1), pa.int32())
            lists = [pa.ListArray.from_arrays(one, few.column(1)), pa.ListArray.from_arrays(one, pa.array(np.zeros(few.num_rows, np.int32)))]
            yield pa.RecordBatch.from_arrays([few.column(0), few.column(0), *few.columns[2:], *lists], DEALT)
        several = every.filter(many)
        for first in range(0, several.num_rows, STRETCHES_AT_ONCE // 4):
            part = several.slice(first, STRETCHES_AT_ONCE // 4)
            anchor, content, doc, twin, start = (part.column(k).to_numpy() for k in range(5))
            data, starts, owner, within = _windows(part.column(5))
            rank = _ranked(data, starts, np.unique(anchor, return_inverse=True)[1][owner])
            order = np.lexsort((start[owner] + within, twin[owner], doc[owner], rank))
            cut = np.flatnonzero(np.concatenate([[True], np.diff(rank[order]) != 0]))
            lead, whose = order[cut], owner[order[cut]]
            windows = _bytes_at(data, starts[lead])
            lists = pa.array(np.append(cut, len(order)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_window_keys(windows)), pa.array(anchor[whose]), pa.array(doc[whose]), pa.array(twin[whose]), pa.array(start[whose] + within[lead]),
                    pa.array([w.tobytes() for w in windows], pa.binary()),
                    pa.ListArray.from_arrays(lists, pa.array(content[owner[order]])),
                    pa.ListArray.from_arrays(lists, pa.array(within[order], pa.int32())),
                ],
                DEALT,
            )


DEALT = ["key", "anchor", "doc", "twin", "start", "string", "contents", "ks"]


def _sorted_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For stretches, their windows that also start at an earlier place: offsets from the stretch's start.

    Rows come in order of key and place, so of a key that goes on from frame to frame only the
    different windows must be remembered: one, but for clashes of keys.
    """
    seen: set[bytes] = set()
    key_before = None
    for frame, goes_on in _by_key(batches, "key", STRETCHES_AT_ONCE):
        keys = frame["key"].to_numpy()
        data, starts, owner, within = _windows(pa.array(frame["string"], pa.binary()))
        rank = _ranked(data, starts, (np.cumsum(np.diff(keys, prepend=keys[0]) != 0))[owner])
        start = frame["start"].to_numpy()[owner] + within
        tied = np.flatnonzero(np.bincount(rank)[rank] > 1)
        whose = owner[tied]
        order = tied[np.lexsort((start[tied], frame["twin"].to_numpy()[whose], frame["doc"].to_numpy()[whose], rank[tied]))]
        again = np.zeros(len(owner), bool)
        again[order[1:]] = rank[order[1:]] == rank[order[:-1]]
        if key_before is not None and keys[0] == key_before:
            for k in np.flatnonzero(keys[owner] == key_before):
                again[k] |= data[starts[k] : starts[k] + LENGTH].tobytes() in seen
        else:
            seen = set()
        key_before = keys[-1] if goes_on else None
        if goes_on:
            seen |= {data[starts[k] : starts[k] + LENGTH].tobytes() for k in np.unique(rank, return_index=True)[1]}
        yield _offsets(frame, owner, within, np.flatnonzero(again))


def _offsets(frame: pd.DataFrame, owner: np.ndarray, within: np.ndarray, hit: np.ndarray) -> pa.RecordBatch:
    """anchor, content and offsets: windows that were hit for the first stretch of a row, the whole string for its others."""
    anchor = frame["anchor"].to_numpy()
    stands_for = np.fromiter(map(len, frame["contents"]), np.int64, len(frame))
    contents, ks = np.concatenate(frame["contents"].tolist()), np.concatenate(frame["ks"].tolist())
    first = np.cumsum(stands_for) - stands_for
    other = np.setdiff1d(np.arange(len(contents)), first)
    rows, n = np.unique(owner[hit], return_counts=True)
    values = np.concatenate([within[hit] + ks[first[owner[hit]]], ks[other]])
    ends = np.cumsum(np.concatenate([[0], n, np.ones(len(other), np.int64)]))
    whose = np.repeat(np.arange(len(frame)), stands_for)[other]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([anchor[rows], anchor[whose]])),
            pa.array(np.concatenate([contents[first[rows]], contents[other]])),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32())),
        ],
        ["anchor", "content", "again"],
    )


def repeated_bytes(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes) for every row of docs.

    A byte goes if a window of LENGTH bytes that covers it also starts earlier: in a smaller id, or
    in the same id at an earlier byte. Null texts count as empty. Rows of null id come before all
    others, as one document; rows that repeat an id are ordered by a hash of their texts, and rows
    that repeat id and text both count once and get the same result. An empty table gives no rows.
    Two stretches count as equal by a 128-bit hash; different ones are compared byte by byte.
    """
    kind = docs.schema[id].dataType.simpleString()
    texts, buckets = _bucketed(docs, id, text)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, twin, bucket = (batch.column(k).to_numpy().astype(np.int64) for k in range(3))
            parts = []
            for first, _, offsets, found in _stretches(batch.column(3)):
                whose = found.text + first
                parts.append(np.stack([found.anchor, found.content, bucket[whose], doc[whose], twin[whose], _packed(found, offsets)]))
                if sum(part.shape[1] for part in parts) >= JOINED:
                    yield _joined(np.concatenate(parts, axis=1))
                    parts = []
            if parts:
                yield _joined(np.concatenate(parts, axis=1))

    bucket_of = F.pmod(F.xxhash64("doc", F.lit(7)), F.lit(buckets)).cast("int")
    rows = texts.mapInArrow(stretches, "anchor long, content long, doc long, twin long, at long, n long")
    judged = rows.repartition("anchor").sortWithinPartitions("anchor", "content", "doc", "twin", "at").withColumn("bucket", bucket_of).mapInArrow(
        _judge, "bucket int, anchor long, content long, doc long, twin long, at long, stretches long, is_first boolean"
    )
    with small_batches(docs.sparkSession):
        judged = kept(judged, "repeats")

    def fetch(asked: pa.Table, rows: pa.Table) -> pa.Table:
        anchor, content, doc, twin, at, stretches = (asked.column(c).to_numpy() for c in ("anchor", "content", "doc", "twin", "at", "stretches"))
        data, offsets = text_bytes(rows.column("text").combine_chunks())
        row = Pairs(rows.column("doc").to_numpy(), rows.column("twin").to_numpy()).rows(doc, twin)
        place, before, size = at >> 16, at >> 8 & 0xFF, (at & 0xFF) + LENGTH
        ends = np.append(0, np.cumsum(size)).astype(np.int32)
        picked = data[gather(offsets[row] + place - before, size)]
        strings = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(picked)])
        return pa.table([anchor, content, doc, twin, place, stretches, before, strings], FETCHED)

    asked = judged.where("stretches > 1 and is_first")
    asked = asked.withColumn("bucket", bucket_of).select("bucket", "anchor", "content", "doc", "twin", "at", "stretches")
    fetched = asked.groupBy("bucket").cogroup(texts.groupBy("bucket")).applyInArrow(
        fetch, "anchor long, content long, doc long, twin long, at long, stretches long, before long, stretch binary"
    )
    strings = fetched.mapInArrow(
        _dealt, "key long, anchor long, doc long, twin long, start long, string binary, contents array<long>, ks array<int>"
    )
    windows = strings.repartition("key").sortWithinPartitions("key", "doc", "twin", "start").mapInArrow(
        _sorted_windows, "anchor long, content long, again array<int>"
    )
    windows = windows.groupBy("anchor", "content").agg(F.flatten(F.collect_list("again")).alias("again"))
    verdicts = judged.join(windows, ["anchor", "content"], "left").select("bucket", "anchor", "content", "doc", "twin", "at", "again")

    def remove(verdicts: pa.Table, rows: pa.Table) -> pa.Table:
        anchor, content, doc, twin, at = (verdicts.column(c).to_numpy() for c in ("anchor", "content", "doc", "twin", "at"))
        known = Pairs(anchor, content)
        again = verdicts.column("again").combine_chunks()
        again_at, again_n = again.offsets.to_numpy()[:-1], pc.fill_null(pc.list_value_length(again), 0).to_numpy()
        again = again.values.to_numpy()
        docs_, twins = rows.column("doc").to_numpy(), rows.column("twin").to_numpy()
        out = []
        for first, data, offsets, found in _stretches(rows.column("text").combine_chunks()):
            row = known.rows(found.anchor, found.content)
            hit = np.flatnonzero(row >= 0)
            row, low, whose = row[hit], found.low[hit], found.text[hit] + first
            own = (doc[row] == docs_[whose]) & (twin[row] == twins[whose]) & (at[row] == _packed(found, offsets)[hit])
            change = np.zeros(len(data) + 1, np.int64)
            change[low[~own]] += 1  # stretches of a slice have different ends
            change[found.high[hit][~own] + LENGTH] -= 1
            row, low = row[own], low[own]
            starts = again[gather(again_at[row], again_n[row])] + np.repeat(low, again_n[row])
            np.add.at(change, starts, 1)
            np.add.at(change, starts + LENGTH, -1)
            gone = np.cumsum(change[:-1]) > 0
            new = gone.copy()
            new[1:] &= ~gone[:-1]
            begin = offsets[:-1][np.diff(offsets) > 0]
            new[begin] = gone[begin]
            n_gone, n_new = (np.append(0, np.cumsum(marks))[offsets] for marks in (gone, new))
            left, ends = data[~gone], offsets - n_gone
            digests = [sha256(left[a:b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            texts_left = pa.Array.from_buffers(pa.binary(), len(digests), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(left)])
            out.append(pa.table([docs_[first : first + len(digests)], np.diff(offsets), np.diff(n_gone), np.diff(n_new), pa.array(digests, pa.string()), texts_left], DONE))
        return pa.concat_tables(out)

    done = verdicts.groupBy("bucket").cogroup(texts.groupBy("bucket")).applyInArrow(
        remove, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    return done.select(F.when(F.col("doc") != NO_ID, F.col("doc")).cast(kind).alias(id), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


SPREAD = ["anchor", "content", "doc", "twin", "at", "n"]
FETCHED = ["anchor", "content", "doc", "twin", "at", "stretches", "before", "stretch"]
DONE = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

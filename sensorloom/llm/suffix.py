"""Removal of repeated byte strings with suffix arrays, built by linear grouping.

Strings of ``LENGTH`` bytes are compared across all documents. Each such window has one anchor, the
position of the least hash of a shorter string in it, and equal windows have equal anchors at equal
places. Neighbouring windows with one anchor form a stretch. The shuffle brings stretches with
equal anchors together; where stretches are equal as a whole, all but the earliest repeat. Where
they share only a part, a suffix array over their bytes finds the equal windows.

The suffix array is built without recursion: suffixes are grouped by their Lyndon prefix, groups
are taken in descending order, each extends the prefix of the nearest smaller suffix before its
members, and the final order of each group follows from the order of the suffixes behind the
prefix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix64, slices, stored, whole_groups
from .hashing import prefix, rolling, spans, text_bytes

LENGTH = 100
ANCHOR = 50
SLICE_BYTES = 1 << 20
# Suffix arrays are built over so many bytes at a time; a group of stretches is never cut.
BLOCK_BYTES = 1 << 14
# Stretches of larger groups are cut into their windows before they are brought together.
SPLIT_STRETCHES = 8192

_STRETCHES_DDL = "anchor long, stretch long, id long, place long"
_JUDGED_DDL = "id long, start long, end long, anchor_at int, stretches long"
_SPANS_DDL = "id long, start long, end long"
_BYTES_DDL = "key long, id long, start long, end long, bytes binary"


def suffix_order(text: bytes | list[int]) -> list[int]:
    """Starts of the suffixes of ``text`` in ascending order."""
    n = len(text) + 1
    group_of = [0] * n  # group 0 holds the empty suffix, which is least
    members = [[n - 1]]
    spots: dict[int, list[int]] = {}
    for i, symbol in enumerate(text):
        spots.setdefault(symbol, []).append(i)
    for symbol in sorted(spots):
        for i in spots[symbol]:
            group_of[i] = len(members)
        members.append(spots[symbol])
    above = [*range(1, len(members)), -1]
    below = [*range(-1, len(members) - 1)]
    smaller = [-1] * n  # the nearest suffix before that is in a lower group
    jump = [-1] * n
    done = bytearray(n)
    group = len(members) - 1
    while group:
        own = [i for i in members[group] if group_of[i] == group]
        members[group] = own
        repeats: dict[int, list[int]] = {}
        last, count = -1, 0
        for i in own:
            j = i - 1
            if done[j]:
                j = jump[j]
                while done[j]:
                    j = jump[j]
                jump[i - 1] = j
            smaller[i] = jump[i] = j
            done[i] = 1
            if j == last:
                count += 1
            else:
                if last >= 0:
                    repeats.setdefault(count, []).append(last)
                last, count = j, 1
        if last >= 0:
            repeats.setdefault(count, []).append(last)
        # A prefix that this group follows more often is larger: it goes right above its group
        # first, and those with fewer repeats come between.
        for count in sorted(repeats, reverse=True):
            moved: dict[int, int] = {}
            for j in repeats[count]:
                old = group_of[j]
                new = moved.get(old)
                if new is None:
                    new = moved[old] = len(members)
                    members.append([])
                    above.append(above[old])
                    below.append(old)
                    below[above[old]] = new
                    above[old] = new
                group_of[j] = new
                members[new].append(j)
        group = below[group]
    free = [0] * len(members)
    at, group = 0, 0
    while group != -1:
        free[group] = at
        at += len(members[group])
        group = above[group]
    order = [n - 1] * n
    placed = bytearray(n)
    for i in range(n):
        j = order[i] - 1
        while j >= 0 and not placed[j]:
            group = group_of[j]
            order[free[group]] = j
            free[group] += 1
            placed[j] = 1
            j = smaller[j]
    return order[1:]


def stretches(data: np.ndarray, borders: np.ndarray) -> dict[str, np.ndarray]:
    """The stretches of all texts: first and last window, anchor position, hashes, text number."""
    windows = len(data) - LENGTH + 1
    if windows <= 0:
        empty = np.zeros(0, dtype=np.int64)
        return dict.fromkeys(("first", "last", "at", "text"), empty) | dict.fromkeys(
            ("anchor", "stretch"), empty.astype(np.uint64)
        )
    running = prefix(data)
    hashes = mix64(rolling(running, ANCHOR))
    width = LENGTH - ANCHOR + 1
    least, covered = hashes, 1
    while covered * 2 <= width:
        least = np.minimum(least[:-covered], least[covered:])
        covered *= 2
    if covered < width:
        least = np.minimum(least[: -(width - covered)], least[width - covered :])
    inside = np.ones(windows, dtype=bool)
    for border in borders[(borders > 0) & (borders < len(data))].tolist():
        inside[max(0, border - LENGTH + 1) : border] = False
    same = inside[1:] & inside[:-1] & (least[1:] == least[:-1])
    first = np.flatnonzero(inside & ~np.concatenate([[False], same]))
    last = np.flatnonzero(inside & ~np.concatenate([same, [False]]))
    at = first + np.argmin(hashes[first[:, None] + np.arange(width)], axis=1)
    late = last > at  # the least hash comes twice: later windows have a later anchor
    if late.any():
        rest = np.concatenate([np.arange(a + 1, b + 1) for a, b in zip(at[late], last[late])])
        last = np.where(late, at, last)
        own = np.concatenate(
            [
                part + np.argmin(hashes[part[:, None] + np.arange(width)], axis=1)
                for part in np.array_split(rest, len(rest) // 65536 + 1)
            ]
        )
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (rest[1:] != rest[:-1] + 1)])
        ends = np.concatenate([new[1:], [True]])
        first = np.concatenate([first, rest[new]])
        last = np.concatenate([last, rest[ends]])
        at = np.concatenate([at, own[new]])
    whole = spans(running, first, last + LENGTH)
    layout = (at - first).astype(np.uint64) * np.uint64(256) + (last - first).astype(np.uint64)
    return {
        "first": first,
        "last": last,
        "at": at,
        "text": np.searchsorted(borders, first, side="right") - 1,
        "anchor": hashes[at],
        "stretch": mix64(whole ^ mix64(layout)),
    }


def merged(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Touching and overlapping spans of the same id as one."""
    if not len(ids):
        return ids, starts, ends
    order = np.lexsort((starts, ids))
    ids, starts, ends = ids[order], starts[order], ends[order]
    new_id = np.concatenate([[True], ids[1:] != ids[:-1]])
    # Running maximum of ends within an id: shifted so that ids do not mix.
    group = np.cumsum(new_id) - 1
    shift = group * (int(ends.max()) + 1)
    reach = np.maximum.accumulate(ends + shift) - shift
    new = new_id | np.concatenate([[True], starts[1:] > reach[:-1]])
    final = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(ids) - 1]])
    return ids[new], starts[new], reach[final]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of (id, text) rows. Of equal stretches of a slice only the earliest goes on as
    such; the others repeat it, and are spans: a negative place for the start, and the end."""
    for batch in batches:
        for part in slices(batch, limit=SLICE_BYTES):
            data, borders = text_bytes(part.column(1))
            found = stretches(data, borders)
            ids = part.column(0).to_numpy(zero_copy_only=False)[found["text"]]
            start = found["first"] - borders[found["text"]]
            more = found["last"] - found["first"]
            order = np.lexsort((start, ids, found["stretch"], found["anchor"]))
            anchor, stretch = found["anchor"][order], found["stretch"][order]
            same = (anchor[1:] == anchor[:-1]) & (stretch[1:] == stretch[:-1])
            earliest = np.concatenate([[True], ~same])[: len(order)]
            keep, drop = order[earliest], order[~earliest]
            place = start << 16 | (found["at"] - found["first"]) << 8 | more
            one, two, three = merged(ids[drop], start[drop], start[drop] + more[drop] + LENGTH)
            yield _batch(
                _STRETCHES_DDL,
                np.concatenate([found["anchor"][keep], mix64(one.view(np.uint64))]).view(np.int64),
                np.concatenate([found["stretch"][keep].view(np.int64), three]),
                np.concatenate([ids[keep], one]),
                np.concatenate([place[keep], -two - 1]),
            )


def _batch(ddl: str, *columns: np.ndarray) -> pa.RecordBatch:
    names = [c.split()[0] for c in ddl.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by anchor, stretch, id and place: spans that repeat, with -1 for the anchor
    position; and the earliest of each stretch whose anchor other stretches have."""
    for batch in whole_groups(batches):
        anchor, stretch, ids, place = (batch.column(n).to_numpy() for n in range(4))
        ready = place < 0
        span_ids, span_starts, span_ends = ids[ready], -place[ready] - 1, stretch[ready]
        anchor, stretch, ids, place = (c[~ready] for c in (anchor, stretch, ids, place))
        start, at, more = place >> 16, place >> 8 & 255, place & 255
        new_anchor = np.ones(len(anchor), dtype=bool)
        new_anchor[1:] = anchor[1:] != anchor[:-1]
        new = new_anchor.copy()
        new[1:] |= stretch[1:] != stretch[:-1]
        group = np.cumsum(new_anchor) - 1
        number = np.bincount(group, new).astype(np.int64)[group] if len(group) else group
        shared = new & (number > 1)
        again = ~new
        out = merged(
            np.concatenate([span_ids, ids[again]]),
            np.concatenate([span_starts, start[again]]),
            np.concatenate([span_ends, start[again] + more[again] + LENGTH]),
        )
        yield _batch(
            _JUDGED_DDL,
            np.concatenate([out[0], ids[shared]]),
            np.concatenate([out[1], start[shared]]),
            np.concatenate([out[2], start[shared] + more[shared] + LENGTH]),
            np.concatenate([np.full(len(out[0]), -1), at[shared]]).astype(np.int32),
            np.concatenate([np.zeros(len(out[0]), dtype=np.int64), number[shared]]),
        )


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of stretches of (id, text, stretches) rows, under a hash of their anchor.

    Of very large groups the windows go on their own, under a hash of the whole window, and of
    equal ones in a slice only the earliest; the others are spans that repeat, without bytes.
    """
    for batch in batches:
        for part in slices(batch):
            rows: list[tuple[int, int, int, bytes | None]] = []
            keyed: list[bytes] = []
            windows: dict[bytes, tuple[int, int]] = {}
            for doc, text, wanted in zip(*(part.column(n).to_pylist() for n in range(3))):
                data = text.encode()
                for s in wanted:
                    start, end, at = s["start"], s["end"], s["start"] + s["anchor_at"]
                    if s["stretches"] <= SPLIT_STRETCHES:
                        rows.append((doc, start, end, data[start:end]))
                        keyed.append(data[at : at + ANCHOR])
                        continue
                    for p in range(start, end - LENGTH + 1):
                        window = data[p : p + LENGTH]
                        first = windows.setdefault(window, (doc, p))
                        if first != (doc, p):
                            windows[window], (other, q) = min(first, (doc, p)), max(first, (doc, p))
                            rows.append((other, q, q + LENGTH, None))
                            keyed.append(b"%d" % other)
            for window, (doc, p) in windows.items():
                rows.append((doc, p, p + LENGTH, window))
                keyed.append(window)
            if rows:
                joined, borders = text_bytes(pa.array(keyed, pa.binary()))
                keys = mix64(spans(prefix(joined), borders[:-1], borders[1:]))
                *numbers, parts = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, (keys.view(np.int64), *numbers)), pa.array(parts, pa.binary())],
                    names=["key", "id", "start", "end", "bytes"],
                )


def _sort_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that repeat, of rows (key, id, start, end, bytes) sorted by key."""
    for batch in whole_groups(batches):
        known = batch.filter(batch.column(4).is_null())
        if known.num_rows:
            yield _batch(_SPANS_DDL, *merged(*(known.column(n).to_numpy() for n in (1, 2, 3))))
        batch = batch.filter(batch.column(4).is_valid())
        keys, ids, starts = (batch.column(n).to_numpy() for n in range(3))
        parts = batch.column(4).to_pylist()
        size, begin = 0, 0
        for n in range(len(parts)):
            size += len(parts[n]) + 1
            ends_group = n + 1 == len(parts) or keys[n + 1] != keys[n]
            if ends_group and (size >= BLOCK_BYTES or n + 1 == len(parts)):
                own = slice(begin, n + 1)
                yield _batch(_SPANS_DDL, *repeats(ids[own], starts[own], parts[own]))
                size, begin = 0, n + 1


def repeats(ids: np.ndarray, starts: np.ndarray, parts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Spans of the windows in ``parts`` that are equal to an earlier one, as (id, start, end)."""
    order = np.lexsort((starts, ids))
    earliest: dict[bytes, int] = {}
    for n in order.tolist():
        earliest.setdefault(parts[n], n)
    one = np.array(sorted(earliest.values()), dtype=np.int64)
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    equal = np.setdiff1d(np.arange(len(parts)), one)
    found = _window_repeats(ids[one], starts[one], [parts[n] for n in one.tolist()])
    whole = (ids[equal], starts[equal], starts[equal] + lengths[equal])
    return merged(*(np.concatenate(pair) for pair in zip(found, whole)))


def _window_repeats(
    ids: np.ndarray, starts: np.ndarray, parts: list[bytes]
) -> tuple[np.ndarray, ...]:
    """``repeats`` of parts that differ, by their suffix array."""
    lengths = np.array([len(p) for p in parts])
    if len(parts) < 2:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty
    joined = b"".join(p + b"\0" for p in parts)  # a border is never inside a window
    begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    owner = np.repeat(np.arange(len(parts)), lengths + 1)
    offset = np.arange(len(joined)) - begins[owner]
    order = np.array(suffix_order(joined))
    order = order[offset[order] + LENGTH <= lengths[owner[order]]]
    windows = [joined[i : i + LENGTH] for i in order.tolist()]
    new = np.array([True, *(a != b for a, b in zip(windows, windows[1:]))])
    group = np.cumsum(new) - 1
    doc, start = ids[owner[order]], starts[owner[order]] + offset[order]
    place = np.lexsort((start, doc, group))
    first = np.concatenate([[True], group[place][1:] != group[place][:-1]])
    again = place[~first]
    return merged(doc[again], start[again], start[again] + LENGTH)


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id (unique), doc_id and text: the smaller id is the earlier document. Equal rows become one;
    rows that share an id follow each other by a hash of the text; null ids come last.

    Unless ids repeat or are missing, a document's id is its own; else all documents are ranked.
    """
    docs = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    odd = docs.groupBy("doc_id").count().where("doc_id is null or count > 1")
    if odd.isEmpty():
        return docs.withColumn("id", F.col("doc_id"))
    keyed = docs.withColumn("hash", F.xxhash64("text"))
    places = stored(_ranked(keyed.select("doc_id", "hash").distinct()), "places")
    both = keyed.alias("a").join(
        places.alias("b"),
        F.expr("a.doc_id <=> b.doc_id and a.hash = b.hash"),
    )
    return stored(both.select("a.doc_id", "a.text", "b.id").distinct(), "numbered")


def _ranked(rows: DataFrame) -> DataFrame:
    """doc_id, hash and id: the rank by doc_id (nulls last) and hash. Rows are sorted in parts of
    the range, each ranked on its own; the sizes of the parts before are added."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = (F.col("doc_id").isNull(), F.col("doc_id"), F.col("hash"))
    split = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # Part number in the high bits, place in the part in the low ones.
    marked = stored(split.withColumn("mark", F.monotonically_increasing_id()), "marks")
    part, low = F.shiftright("mark", 33), F.col("mark").bitwiseAND((1 << 33) - 1)
    sizes = marked.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = marked.withColumn("part", part).join(F.broadcast(starts), "part")
    return placed.select("doc_id", "hash", (F.col("start") + low).alias("id"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (array of start and end) and kept (binary) of each document.

    Removed is every byte of the UTF-8 text that is covered by a string of ``LENGTH`` bytes which
    also starts earlier: in a document with a smaller id, or earlier in the same one. Strings are
    judged on the input, and never cross documents. Spans are the maximal removed runs.

    Stretches meet by the hash of their anchor. A task passes an equal stretch on only once per
    slice of text, so a passage that a third of all documents share costs each task a few rows.
    Anchors and stretches are compared by 64-bit hashes of their bytes, both of which must agree.

    Null and empty texts have no bytes; equal rows are one document and give one row; rows that
    share an id are ordered by a hash of their text, and rows without an id come last; other
    columns are ignored; an empty table gives no rows.
    """
    numbered = _numbered(docs, id_col, text_col)
    texts = numbered.select("id", "text")
    read = texts.mapInArrow(_read, _STRETCHES_DDL).repartition("anchor")
    read = read.sortWithinPartitions("anchor", "stretch", "id", "place")
    judged = stored(read.mapInArrow(_judge, _JUDGED_DDL), "judged")
    shared = judged.where("anchor_at >= 0").groupBy("id").agg(
        F.collect_list(F.struct("start", "end", "anchor_at", "stretches")).alias("wanted")
    )
    fetched = texts.join(shared.hint("shuffle_hash"), "id").select("id", "text", "wanted")
    fetched = fetched.mapInArrow(_fetch, _BYTES_DDL).repartition("key")
    sorted_spans = fetched.sortWithinPartitions("key").mapInArrow(_sort_suffixes, _SPANS_DDL)
    found = judged.where("anchor_at < 0").select("id", "start", "end").unionByName(sorted_spans)
    by_doc = found.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    joined = numbered.join(by_doc.hint("shuffle_hash"), "id", "left")
    return joined.select("doc_id", "text", "found").mapInArrow(
        _cut, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        for part in slices(batch, limit=SLICE_BYTES):
            sizes, all_spans, kept = [], [], []
            for text, found in zip(part.column(1).to_pylist(), part.column(2)):
                data = text.encode()
                found = found.as_py() or ()
                starts = np.array([f["start"] for f in found], dtype=np.int64)
                ends = np.array([f["end"] for f in found], dtype=np.int64)
                _, starts, ends = merged(np.zeros_like(starts), starts, ends)
                cuts = [0, *np.column_stack([starts, ends]).ravel().tolist(), len(data)]
                sizes.append(len(data))
                all_spans.append([{"start": a, "end": b} for a, b in zip(cuts[1:-1:2], cuts[2::2])])
                kept.append(b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(all_spans, pa.list_(span)),
                 pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

"""Removal of long repeats: matching statistics against run-length indexes.

Every byte covered by a string of ``LENGTH`` bytes that also starts in a document with a
smaller id is removed. Equal strings have to meet without every text meeting every other,
so each string of that length (window) names one of its ``SEED``-byte pieces, the one of
the smallest hash, as its seed: equal windows name equal seeds at the same offset. A seed
with all consecutive windows that name it is a segment of the text.

1. One scan lists the seeds of each text. Seeds are dealt by hash; those of two documents
   or more are shared. Rows that share a seed within a task are settled there and the task
   hands on one entry for it, so a passage that a third of all rows hold gives one entry
   a task.
2. Texts with shared seeds cut the segments of these, dealt by seed again. The different
   segments of a bucket form the text of run-length indexes (``run_index``) of about
   ``INDEX_BYTES``; they are streamed through, and a window whose match is ``LENGTH`` long
   learns from its row's group the smallest id that holds it. Documents with larger ids
   get it as a span.
3. A seed that more than ``HOT`` rows hold could overfill its bucket: its windows are dealt
   one by one, by their own bytes, each task handing on a window once with its smallest id;
   the index's answer is joined back to the rows that hold it.
4. The spans of a document are joined to its text, which drops them.

Exact copies of a text with a smaller id are known by digest and lose all their windows
without steps 2 and 3. All tables between steps lie in the shared folder; the driver
collects the hot seeds only, at most (seeds / ``HOT``).

Defined results: null and empty texts have 0 bytes and keep the digest of nothing; texts
shorter than ``LENGTH`` keep all; rows with a null id lose nothing and make nothing go;
rows with the same id take nothing from each other, repeated rows get the same result;
an empty table gives no rows; other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.run_index import END, RunIndex
from auric.llm.tables import materialize, table
from auric.llm.text import U, _powers, mix, runs

LENGTH, SEED = 50, 24
HOT = 1 << 20
SEEDS_AT_ONCE = 1 << 21
SEGMENT_BYTES = 8 << 20
BUCKET_SEEDS = 1 << 22
INDEX_BYTES = 2 << 20

_CODE = mix(np.arange(256).astype(U) + U(1))


def seeds(data: np.ndarray, off: np.ndarray, length: int, size: int):
    """Windows of a run of texts and their seeds: (hash of the piece at each position,
    windows, the seed's position of each window)."""
    n = len(data)
    if n < length:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    p, inv = _powers(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum(_CODE[data] * p[:n], out=total[1:])
    piece = mix((total[size:] - total[:-size]) * inv[:n - size + 1])
    many = length - size + 1                       # pieces of a window
    value, at = piece, np.arange(len(piece))
    span = 1
    while span < many:                             # leftmost smallest of ``span`` pieces
        step = min(span, many - span)
        right = value[step:] < value[:-step]
        value, at = (np.where(right, x[step:], x[:-step]) for x in (value, at))
        span += step
    sizes = np.diff(off)
    inside = np.arange(n - length + 1) + length <= np.repeat(off[1:], sizes)[:n - length + 1]
    window = np.flatnonzero(inside)
    return piece, window, at[window]


def _runs_of(*columns: np.ndarray) -> np.ndarray:
    """Where a new run of equal values begins (all columns taken together)."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def _lists(values: np.ndarray, first: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind))


def _binary(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _numbers(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in column]


def _once(batch: pa.RecordBatch, seen: set[bytes]) -> pa.RecordBatch:
    """The rows whose key (the first column) is not in ``seen`` yet: rows of the same id and
    text have the same result, and a task looks at one of them."""
    keep = []
    for key in batch.column(0).to_pylist():
        keep.append(key not in seen)
        seen.add(key)
    return batch if all(keep) else batch.filter(pa.array(keep, pa.bool_()))


_BY_SHARD = "shard int, keys binary, sizes binary, numbers binary"


def _by_shard(keys: np.ndarray, numbers: np.ndarray, first: np.ndarray, shards: int) -> pa.Table:
    """Lists of numbers for keys (rows of two words), as one row for each shard of keys."""
    sizes = np.diff(np.append(first, len(numbers)))
    shard = (keys[:, 0] % U(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    begin = _runs_of(shard[order])
    parts = np.split(order, begin[1:]) if len(order) else []
    chunk = np.split(numbers, first[1:]) if len(order) else []
    return pa.table({
        "shard": pa.array([int(shard[p[0]]) for p in parts], pa.int32()),
        "keys": pa.array([_binary(keys[p]) for p in parts], pa.binary()),
        "sizes": pa.array([_binary(sizes[p].astype(np.uint32)) for p in parts], pa.binary()),
        "numbers": pa.array([_binary(np.concatenate([chunk[i] for i in p.tolist()])
                                     .astype(np.int32)) for p in parts], pa.binary())})


def _gathered(group: pa.Table) -> pa.Table:
    """(key, numbers): all lists of a key in one."""
    keys = np.concatenate(_numbers(group.column("keys"), U)).reshape(-1, 2)
    sizes = np.concatenate(_numbers(group.column("sizes"), np.uint32)).astype(np.int64)
    numbers = np.concatenate(_numbers(group.column("numbers"), np.int32))
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = _runs_of(keys[order, 0], keys[order, 1])
    sizes_in_order = sizes[order]
    begin = (np.cumsum(sizes) - sizes)[order]
    ends = np.cumsum(sizes_in_order)
    at = np.arange(len(numbers)) + np.repeat(begin - (ends - sizes_in_order), sizes_in_order)
    first = np.append((ends - sizes_in_order)[new], len(numbers))
    return pa.table({"key": pa.array([x.tobytes() for x in keys[order[new]]], pa.binary()),
                     "numbers": _lists(numbers[at], first, pa.int32())})


def _gather(found: DataFrame, name: str) -> DataFrame:
    return (found.where("shard is not null").select("shard", "keys", "sizes", "numbers")
            .groupBy("shard").applyInArrow(_gathered, "key binary, numbers array<int>")
            .withColumnRenamed("numbers", name))


def _with(rows: pa.Table, **more: pa.Array) -> pa.Table:
    """``rows``, then rows that hold only the columns ``more``."""
    n = len(next(iter(more.values())))
    columns = {c: pa.concat_arrays([rows.column(c).combine_chunks(), pa.nulls(n, rows.column(c).type)])
               for c in rows.column_names}
    columns |= {c: pa.concat_arrays([pa.nulls(rows.num_rows, v.type), v]) for c, v in more.items()}
    return pa.table(columns)


_SEEDS = ("bucket int, hash binary, many binary, owner binary, place binary, keys binary, "
          "settled boolean")


def _seed_rows(buckets: int, length: int, size: int):
    """The seeds of a task's texts, dealt to buckets by hash."""

    def emit(bucket, h, many, owner, place, keys, settled):
        rows, owner = np.unique(owner, return_inverse=True)
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array([bucket], pa.int32()),
            "hash": [_binary(h.astype(np.uint32))], "many": [_binary(many.astype(np.uint32))],
            "owner": [_binary(owner.astype(np.uint32))],
            "place": [_binary(place.astype(np.uint32))],
            "keys": [b"".join(keys[r] for r in rows.tolist())],
            "settled": pa.array([settled])})

    def flush(parts, keys):
        h, owner, place = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((place, owner, h))
        h, owner, place = h[order], owner[order], place[order]
        own = _runs_of(h, owner)                   # a text's first place of a seed
        h, owner, place = h[own], owner[own], place[own]
        begin = _runs_of(h)
        many = np.diff(np.append(begin, len(h)))
        shared = np.flatnonzero(np.repeat(many > 1, many))
        if len(shared):                            # to any bucket, as nothing is compared
            yield emit(int(h[0] % U(buckets)), h[shared], h[shared], owner[shared],
                       place[shared], keys, True)
        h, owner, place = h[begin], owner[begin], place[begin]
        bucket = ((h >> U(32)) % U(buckets)).astype(np.int64)
        order = np.lexsort((place, owner, bucket))
        first = _runs_of(bucket[order])
        for at in np.split(order, first[1:]):
            yield emit(int(bucket[at[0]]), h[at], many[at], owner[at], place[at], keys, False)

    def run(batches):
        parts, keys, held, seen = [], [], 0, set()
        for b in batches:
            b = _once(b, seen)
            for lo, hi, data, off in runs(b.column(1)):
                piece, window, at = seeds(data, off, length, size)
                new = _runs_of(at)
                at, window = at[new], window[new]
                row = np.searchsorted(off, window, "right") - 1
                parts.append((piece[at], row + len(keys), at - off[row]))
                keys += b.column(0).slice(lo, hi - lo).to_pylist()
                held += len(at)
                if held >= SEEDS_AT_ONCE:
                    yield from flush(parts, keys)
                    parts, keys, held = [], [], 0
        if held:
            yield from flush(parts, keys)
    return run


_SHARED = f"{_BY_SHARD}, hot bigint"


def _shared_seeds(hot: int, shards: int):
    """The places of the seeds of a bucket that two tasks' rows or more hold, by row, and
    the seeds of more than ``hot`` rows."""

    def run(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        settled = group.column("settled").to_numpy()
        h, many, owner, place = (_numbers(group.column(c), np.uint32)
                                 for c in ("hash", "many", "owner", "place"))
        keys = [k.reshape(-1, 2) for k in _numbers(group.column("keys"), U)]
        base = np.cumsum([0] + [len(k) for k in keys])
        key = np.concatenate(keys)
        owner = np.concatenate([o.astype(np.int64) + b for o, b in zip(owner, base)])
        known = np.repeat(settled, [len(x) for x in h])
        h, place = np.concatenate(h), np.concatenate(place)
        many = np.where(known, 0, np.concatenate(many)).astype(np.int64)
        open_ = np.flatnonzero(~known)
        order = open_[np.argsort(h[open_], kind="stable")]
        begin = _runs_of(h[order])
        runs_ = np.diff(np.append(begin, len(order)))
        total = np.add.reduceat(many[order], begin) if len(begin) else begin
        over = h[order][begin][total > hot].astype(np.int64)
        # a seed whose rows are all in one task was settled there
        mine = np.concatenate([order[np.repeat(runs_ > 1, runs_)], np.flatnonzero(known)])
        mine = mine[np.argsort(owner[mine], kind="stable")]
        first = _runs_of(owner[mine])
        return _with(_by_shard(key[owner[mine][first]], place[mine], first, shards),
                     hot=pa.array((bucket << 32) | over, pa.int64()))
    return run


_SEGMENTS = ("bucket int, data binary, size binary, seed binary, ids binary, keys binary, "
             "start binary, window binary, key binary, id bigint, at int")


def _segments(buckets: int, length: int, size: int, seed_buckets: int, hot):
    """The segments of shared seeds, dealt by seed; of hot seeds their windows, dealt by
    their bytes (each once, with its smallest id) and listed by row."""
    names = [x.split()[0] for x in _SEGMENTS.split(", ")]
    kinds = [pa.int32()] + [pa.binary()] * 6 + [pa.binary(), pa.binary(), pa.int64(), pa.int32()]

    def batch(**columns):
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], k) if c in columns else pa.nulls(n, k)
             for c, k in zip(names, kinds)], names)

    def deal(held):
        route, texts, ids, keys, start = (sum((x[k] for x in held), []) for k in range(5))
        route = np.array(route, U)
        bucket = ((route >> U(20)) % U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for at in np.split(order, _runs_of(bucket[order])[1:]):
            mine = at.tolist()
            yield batch(
                bucket=[int(bucket[mine[0]])], data=[b"".join(texts[i] for i in mine)],
                size=[_binary(np.array([len(texts[i]) for i in mine], np.uint32))],
                seed=[_binary(route[at])],
                ids=[_binary(np.array([ids[i] for i in mine], np.int64))],
                keys=[b"".join(keys[i] for i in mine)],
                start=[_binary(np.array([start[i] for i in mine], np.uint32))])

    def run(batches):
        hot_seeds = hot.value
        held, many, seen = [], 0, set()
        for b in batches:
            b = _once(b, seen)
            for lo, hi, data, off in runs(b.column(2)):
                piece, window, at = seeds(data, off, length, size)
                new = _runs_of(at)
                last = window[np.append(new[1:], len(at)) - 1] if len(new) else new
                seed, begin = at[new], window[new]
                row = np.searchsorted(off, begin, "right") - 1
                # the seeds that were found shared, wherever else they stand in the text
                h = piece[seed]
                own = mix(h + (row.astype(U) << U(40)))
                places = b.column(3).slice(lo, hi - lo)
                wanted = places.flatten().to_numpy() + np.repeat(
                    off[:-1], np.diff(places.offsets.to_numpy()))
                mark = np.zeros(len(data) + 1, bool)
                mark[np.minimum(wanted, len(data))] = True
                on = np.isin(own, own[mark[seed]])
                seed, begin, last, row, h = (x[on] for x in (seed, begin, last, row, h))
                keys, ids = b.column(0).slice(lo, hi - lo).to_pylist(), b.column(1).slice(
                    lo, hi - lo).to_pylist()
                raw = data.tobytes()
                code = (((h >> U(32)) % U(seed_buckets)) << U(32)) | (h & U(0xFFFFFFFF))
                is_hot = np.isin(code.astype(np.int64), hot_seeds)
                cold = np.flatnonzero(~is_hot).tolist()
                rows, starts, ends = row.tolist(), begin.tolist(), (last + length).tolist()
                part = ([int(h[i]) for i in cold], [raw[starts[i]:ends[i]] for i in cold],
                        [ids[rows[i]] for i in cold], [keys[rows[i]] for i in cold],
                        [starts[i] - int(off[rows[i]]) for i in cold])
                windows: dict[bytes, int] = {}
                refs = ([], [], [], [])
                for i in np.flatnonzero(is_hot).tolist():
                    for s in range(starts[i], ends[i] - length + 1):
                        w, r = raw[s:s + length], rows[i]
                        if windows.get(w, ids[r]) >= ids[r]:
                            windows[w] = ids[r]
                        refs[0].append(hashlib.sha256(w).digest())
                        refs[1].append(keys[r])
                        refs[2].append(ids[r])
                        refs[3].append(s - int(off[r]))
                if refs[0]:
                    yield batch(window=refs[0], key=refs[1], id=refs[2], at=refs[3])
                for w, i in windows.items():       # no key: the answer goes to all its rows
                    for x, v in zip(part, (int.from_bytes(hashlib.sha256(w).digest()[:8], "big"),
                                           w, i, bytes(16), 0)):
                        x.append(v)
                held.append(part)
                many += sum(map(len, part[1]))
                if many >= SEGMENT_BYTES:
                    yield from deal(held)
                    held, many = [], 0
        if many:
            yield from deal(held)
    return run


_SPANS = f"{_BY_SHARD}, window binary, least bigint"


def least_ids(texts: list[bytes], seed: np.ndarray, least: np.ndarray, length: int,
              index_bytes: int = INDEX_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the different ``texts`` the smallest of the ids (``least``, one
    for each text) of texts that hold it, found by matching statistics; windows of one text
    lie together from ``first[k]`` on. Equal windows are of texts of one ``seed``."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.concatenate([[0], np.cumsum(np.maximum(size - length + 1, 0))])
    out = np.repeat(least, np.diff(first))
    order = np.argsort(seed, kind="stable")
    begin = _runs_of(seed[order])
    ends = np.append(begin[1:], len(order))
    block, held = [], 0
    for a, b in zip(begin.tolist(), ends.tolist()):
        if b - a > 1:                              # else no other text has its windows
            block.append(order[a:b])
            held += int(size[order[a:b]].sum())
        if held and (held >= index_bytes or b == len(order)):
            _stream(np.concatenate(block), texts, size, least, first, length, out)
            block, held = [], 0
    return out, first


def _stream(mine, texts, size, least, first, length, out):
    """Index the texts ``mine`` and stream them through."""
    close = bytes([END])
    data = np.frombuffer(close.join(texts[i] for i in mine.tolist()) + close, np.uint8)
    start = np.concatenate([[0], np.cumsum(size[mine] + 1)])[:-1]
    index = RunIndex(data, length)
    smallest = index.least_in_groups(np.repeat(least[mine], size[mine] + 1))
    index.forget_order()                           # from here on runs and samples only
    match, row = index.matching_statistics(data, start, size[mine])
    windows = np.diff(first)[mine]
    nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    at = np.repeat(start, windows) + nth
    long = match[at] >= length
    found = smallest[np.searchsorted(index.group, row[at], "right") - 1]
    to = np.repeat(first[:-1][mine], windows) + nth
    out[to] = np.where(long, np.minimum(found, out[to]), out[to])


def _mark(length: int, index_bytes: int, shards: int):
    """Spans of the rows of a bucket, and the smallest id of each hot window."""

    def run(group: pa.Table) -> pa.Table:
        sizes = np.concatenate(_numbers(group.column("size"), np.uint32)).astype(np.int64)
        seed = np.concatenate(_numbers(group.column("seed"), U))
        ids = np.concatenate(_numbers(group.column("ids"), np.int64))
        start = np.concatenate(_numbers(group.column("start"), np.uint32)).astype(np.int64)
        keys = np.concatenate(_numbers(group.column("keys"), U)).reshape(-1, 2)
        different: dict[bytes, int] = {}
        which = np.empty(len(sizes), np.int64)
        n = 0
        for blob, size in zip(group.column("data"), _numbers(group.column("size"), np.uint32)):
            raw, at = blob.as_py(), 0
            for s in size.tolist():
                which[n] = different.setdefault(raw[at:at + s], len(different))
                at += s
                n += 1
        least = np.full(len(different), np.iinfo(np.int64).max)
        np.minimum.at(least, which, ids)
        text_seed = np.zeros(len(different), U)
        text_seed[which] = seed
        smallest, first = least_ids(list(different), text_seed, least, length, index_bytes)

        hot = (keys == 0).all(axis=1)
        texts = list(different)
        answers = np.unique(which[hot])
        rows = np.flatnonzero(~hot)
        many = np.diff(first)[which[rows]]
        owner = np.repeat(rows, many)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        gone = smallest[np.repeat(first[:-1][which[rows]], many) + nth] < ids[owner]
        owner, at = owner[gone], (start[owner] + nth)[gone]
        a, b = keys[owner, 0], keys[owner, 1]
        order = np.lexsort((at, b, a))
        a, b, at = a[order], b[order], at[order]
        # windows of a row that follow each other are one span
        new = np.ones(len(at), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (at[1:] > at[:-1] + 1)
        begin = np.flatnonzero(new)
        end = at[np.append(begin[1:], len(at)) - 1] + length if len(at) else at
        pairs = np.stack([at[begin], end], axis=1).astype(np.int32).ravel()
        by_row = _runs_of(a[begin], b[begin])
        rows = _by_shard(keys[owner[order][begin[by_row]]], pairs, by_row * 2, shards)
        digests = [hashlib.sha256(texts[i]).digest() for i in answers.tolist()]
        return _with(rows, window=pa.array(digests, pa.binary()),
                     least=pa.array(smallest[first[answers]], pa.int64()))
    return run


def _cut(length: int):
    """What is left of each text: n_bytes, n_removed, n_spans, kept."""

    def run(batches):
        for b in batches:
            texts = b.column(1).cast(pa.large_string()).cast(pa.large_binary())
            n_bytes, removed, spans, kept = [], [], [], []
            for text, copy, pairs in zip(texts, b.column(2).to_pylist(), b.column(3)):
                raw = text.as_py()
                if copy and len(raw) >= length:
                    cut = [[0, len(raw)]]
                else:
                    cut = []
                    if pairs.is_valid:
                        p = pairs.values.to_numpy().reshape(-1, 2)
                        for s, e in p[np.argsort(p[:, 0], kind="stable")].tolist():
                            if cut and s <= cut[-1][1]:
                                cut[-1][1] = max(cut[-1][1], e)
                            else:
                                cut.append([s, e])
                edge = [0] + [x for pair in cut for x in pair] + [len(raw)]
                n_bytes.append(len(raw))
                removed.append(sum(e - s for s, e in cut))
                spans.append(len(cut))
                kept.append(b"".join(raw[edge[k]:edge[k + 1]] for k in range(0, len(edge), 2)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                ["_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


class _Source:
    """The documents with the digest of the text and a key of (id, text)."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str):
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        digest = F.unhex(F.sha2("t", 256))
        named = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"),
                         F.lit(b":"), F.col("digest"))
        self.rows = (docs.select(F.col(id_col).cast("bigint").alias("id"), text.alias("t"))
                     .select("id", "t", digest.alias("digest"))
                     .select("id", "t", "digest",
                             F.substring(F.unhex(F.sha2(named, 256)), 1, 16).alias("key")))
        self.known = self.rows.where("id is not null")


def _buckets(df: DataFrame, things: int, most: int) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
               math.ceil(things / most))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    length: int = LENGTH, seed: int = SEED, hot: int = HOT,
                    index_bytes: int = INDEX_BYTES) -> DataFrame:
    """One row for each document: id, n_bytes, n_removed, n_spans and the bytes kept."""
    spark = docs.sparkSession
    source = _Source(docs, id_col, text_col)
    rows = materialize(source.known.select("id", "digest", "key",
                                           F.octet_length("t").cast("bigint").alias("n")), "rows")
    first = (rows.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most"))
             .where("least < most").select("digest", "least"))
    copies = materialize(rows.join(first, "digest").where("id > least").select("key").distinct(),
                         "copies")

    total = rows.agg(F.sum("n")).first()[0] or 0
    seed_buckets = _buckets(docs, 2 * total // (length - seed + 2), BUCKET_SEEDS)
    shared = materialize(
        source.known.select("key", "t")
        .mapInArrow(_seed_rows(seed_buckets, length, seed), _SEEDS)
        .groupBy("bucket").applyInArrow(_shared_seeds(hot, seed_buckets), _SHARED),
        "shared-seeds")
    hot_seeds = np.array([r["hot"] for r in shared.where("hot is not null").select("hot")
                         .collect()], np.int64)
    wanted = materialize(_gather(shared, "places").join(copies, "key", "left_anti"), "wanted")
    many = wanted.agg(F.sum(F.size("places"))).first()[0] or 0

    buckets = _buckets(docs, many * 3 * length // 2, SEGMENT_BYTES)
    segments = (source.known.select("key", "id", "t").join(wanted, "key")
                .select("key", "id", "t", "places")
                .mapInArrow(_segments(buckets, length, seed, seed_buckets,
                                      spark.sparkContext.broadcast(hot_seeds)), _SEGMENTS))
    if len(hot_seeds):                             # read twice
        segments = materialize(segments, "segments")
    found = materialize(
        segments.where("bucket is not null")
        .select("bucket", "data", "size", "seed", "ids", "keys", "start")
        .groupBy("bucket").applyInArrow(_mark(length, index_bytes, buckets), _SPANS), "spans")
    spans = _gather(found, "spans")
    if len(hot_seeds):
        answers = found.where("window is not null").select("window", "least")
        held = segments.where("window is not null").select("window", "key", "id", "at")
        spans = (spans.union(held.join(answers, "window").where("least < id")
                             .select("key", F.array("at", F.col("at") + length).alias("spans")))
                 .groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans")))
    cut = (spans.select("key", F.lit(False).alias("copy"), "spans")
           .union(copies.select("key", F.lit(True), F.lit(None).cast("array<int>"))))
    kind = docs.schema[id_col].dataType.simpleString()
    return (source.rows.select("key", "id", "t").join(cut, "key", "left")
            .select(F.col("id").cast(kind).alias("_id"), "t",
                    F.coalesce("copy", F.lit(False)).alias("copy"), "spans")
            .mapInArrow(_cut(length), f"_id {kind}, n_bytes bigint, n_removed bigint, "
                                      "n_spans bigint, kept binary")
            .withColumnRenamed("_id", id_col))


def op12_run_length_index(spark, sf_dir: str) -> DataFrame:
    return (without_repeats(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_bytes", "n_removed", "n_spans",
                    F.sha2("kept", 256).alias("kept_sha256")))


QUERIES = {"op12_run_length_index": op12_run_length_index}
ORACLE: dict[str, str] = {}

"""Near-duplicate lines: segment-partition edit join with banded bit-parallel verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import cut_lineage, document_key, in_bitmap, mix64, put_aside, release, runs, slices, slot_bitmap, whole_groups
from trialspark.llm.components import connected_components

#: Characters of one block that are compared in one task; a larger block is cut into tiles of about this size.
TILE_CHARS = 1_000_000
_BASE = 0x9E3779B97F4A7C15


def lines_of(text: str | None, shortest: int) -> tuple[list[int], list[str]]:
    """Numbers and normalised forms (white space as one blank) of the lines of at least ``shortest`` characters."""
    number, line = [], []
    for i, raw in enumerate((text or "").split("\n")):
        if len(raw) >= shortest and len(norm := " ".join(raw.split())) >= shortest:
            number.append(i)
            line.append(norm)
    return number, line


def line_ids(lines: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) for x in lines), np.uint64, len(lines)).astype(np.int64)


class Rolling:
    """Hashes of substrings of many lines laid out in one flat array of code points."""

    def __init__(self, lines: list[str]):
        self.length = np.array([len(x) for x in lines], np.int64)
        self.at = np.cumsum(self.length) - self.length
        codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        n = len(codes)
        power = np.cumprod(np.full(n + 1, _BASE, np.uint64))
        self.back = np.cumprod(np.full(n + 1, pow(_BASE, -1, 1 << 64), np.uint64))
        self.total = np.r_[np.uint64(0), np.cumsum((codes + np.uint64(1)) * power[:n])]

    def hash(self, line: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        a = self.at[line] + start
        return mix64((self.total[a + size] - self.total[a]) * self.back[a] + size.astype(np.uint64))


def tiers(distance: int, shortest: int, shorter: tuple[tuple[int, int], ...] = ()) -> list[tuple[int, int | None, int]]:
    """First length, length of the next tier (None: open) and edit distance of each tier of line lengths."""
    steps = sorted({**dict(shorter), shortest: distance}.items())
    if steps[-1][0] != shortest or any(a[1] > b[1] for a, b in zip(steps, steps[1:])):
        raise ValueError("lengths in shorter must lie below shortest, with distances that do not fall with the length")
    return [(low, high, d) for (low, d), high in zip(steps, [*[x for x, _ in steps[1:]], None])]


def segment_keys(lines: list[str], distance: int, low: int = 0, high: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, line and role (1: of the index) of every segment and probe of the lines.

    Lines of ``low`` to under ``high`` characters are indexed.

    A line of length ``l`` is cut into ``distance + 1`` even segments; lines
    within the distance share one of them. A longer line probes for segment ``i``
    of the lines of length ``l`` at the places that an alignment with at most
    ``i`` edits before and the others behind can reach. The key holds ``l``, ``i``
    and the substring. Probes at the segment's own place in lines of equal
    length are the index entry itself.
    """
    rolling, parts = Rolling(lines), distance + 1
    size = rolling.length
    every = np.arange(len(lines))
    keys, rows, roles = [], [], []
    for less in range(parts):
        length = size - less
        fits = every[(length >= max(parts, low)) & (length < (high or np.inf))]
        l_fit, s_fit = length[fits], size[fits]
        for i in range(parts):
            # the last l % parts segments are one character longer
            short = l_fit // parts
            longer = parts - l_fit % parts
            seg = short + (i >= longer)
            start = i * short + np.maximum(0, i - longer)
            least = np.maximum(np.maximum(0, start - i), start + less - (distance - i))
            most = np.minimum(np.minimum(s_fit - seg, start + i), start + less + (distance - i))
            for step in range(2 * distance + 1):
                at = least + step
                inside = at <= most
                if not inside.any():
                    break
                line, begin = fits[inside], at[inside]
                tag = (l_fit[inside] * parts + i).astype(np.uint64)
                keys.append(mix64(rolling.hash(line, begin, seg[inside]) + mix64(tag)))
                rows.append(line)
                roles.append((begin == start[inside]) & (less == 0))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(keys).astype(np.int64), np.concatenate(rows), np.concatenate(roles)


def deletion_keys(lines: list[str], low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, line and role (1: of the index) of the lines of ``low`` to under ``high`` characters, whole and without each one character.

    Lines of one edit share such a key. The segments of short lines are so short
    that very many lines would meet under them. Lines of ``high`` characters
    only probe.
    """
    rolling = Rolling(lines)
    size = rolling.length
    whole = np.flatnonzero((size >= low) & (size < high))
    less = np.flatnonzero((size >= low) & (size <= high))
    row = np.repeat(less, size[less])
    at = np.arange(len(row)) - np.repeat(np.cumsum(size[less]) - size[less], size[less])
    first, gone = rolling.at[row], rolling.at[row] + at
    rest = rolling.total[first + size[row]] - rolling.total[gone + 1]
    value = (rolling.total[gone] - rolling.total[first] + rest * rolling.back[0]) * rolling.back[first]
    keys = [rolling.hash(whole, np.zeros(len(whole), np.int64), size[whole]), mix64(value + (size[row] - 1).astype(np.uint64))]
    roles = [np.ones(len(whole), bool), size[row] < high]
    return np.concatenate(keys).astype(np.int64), np.concatenate([whole, row]), np.concatenate(roles)


def within(codes: np.ndarray, at: np.ndarray, size: np.ndarray, x: np.ndarray, y: np.ndarray, distance: int) -> np.ndarray:
    """Whether lines ``x`` and ``y`` (same number of pairs) lie within the edit distance.

    Bit ``k`` of ``state[d]`` says that so many characters of the one line and
    ``k - distance`` more of the other agree with at most ``d`` edits; one step
    per character moves the whole band, for all pairs at once.
    """
    width = 2 * distance + 1
    out = np.zeros(len(x), bool)
    # pairs of like length together, the longest first, so that the first of a block bounds what it allocates
    order = np.argsort(-size[x], kind="stable")
    at_pair = 0
    while at_pair < len(order):
        longest = int(size[x[order[at_pair]]])
        take = max(1, min(8192, 4_000_000 // (longest + 1)))
        own = order[at_pair : at_pair + take]
        at_pair += take
        a, b = x[own], y[own]
        la, lb = size[a], size[b]
        n = int(la.max())
        pad = np.uint32(0xFFFFFFFF)
        place = np.arange(n)
        left = np.where(place < la[:, None], codes[np.minimum(at[a][:, None] + place, len(codes) - 1)], pad).T.copy()
        wide = np.arange(-distance, n + distance)
        right = np.where((wide >= 0) & (wide < lb[:, None]), codes[np.clip(at[b][:, None] + wide, 0, len(codes) - 1)], pad - np.uint32(1)).T.copy()
        full = (1 << width) - 1
        state = [np.full(len(own), ((1 << (d + 1)) - 1) << distance, np.int64) & full for d in range(distance + 1)]
        last = [np.zeros(len(own), np.int64) for _ in state]
        same = np.zeros((n, len(own)), np.int64)
        for k in range(width):
            same |= (left == right[k : k + n]).astype(np.int64) << k
        for i in range(n + 1):
            ends = la == i
            if ends.any():
                for d, s in enumerate(state):
                    last[d][ends] = s[ends]
            if i == n:
                break
            before = state
            state = []
            for d in range(distance + 1):
                now = before[d] & same[i]
                if d:
                    now |= before[d - 1] | (before[d - 1] >> 1) | (state[d - 1] << 1)
                state.append(now & full)
        final = distance + lb - la
        reach = (final >= 0) & (final < width)
        out[own] = reach & ((last[distance] >> np.clip(final, 0, width - 1)) & 1 == 1)
    return out


def _keys(steps: list[tuple[int, int | None, int]]):
    shortest = min(low for low, _, distance in steps if distance)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text", 1 << 19):
            lines = list(dict.fromkeys(x for t in batch.column("text").to_pylist() for x in lines_of(t, shortest)[1]))
            ids = line_ids(lines)
            new = [i for i, h in enumerate(ids.tolist()) if h not in seen]
            seen.update(ids[new].tolist())
            own = [lines[i] for i in new]
            found = [deletion_keys(own, low, high) if high and distance == 1 else segment_keys(own, distance, low, high) for low, high, distance in steps if distance]
            key, row, role = (np.concatenate(f) for f in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids[new][row]), pa.array(role)], ["key", "line", "indexed"])

    return emit


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys under which an indexed line meets another line."""
    for table in whole_groups(batches, "key"):
        key, line = (table.column(c).to_numpy() for c in ("key", "line"))
        role = table.column("indexed").to_numpy()
        order = np.lexsort((line, key))
        key, line, role = key[order], line[order], role[order]
        starts, sizes = runs(key)
        indexed = np.logical_or.reduceat(role, starts)
        several = line[starts] != line[starts + sizes - 1]
        own = np.repeat(indexed & several, sizes)
        once = np.r_[True, (key[1:] != key[:-1]) | (line[1:] != line[:-1])]
        keep = own & once
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(line[keep])], ["key", "line"])


def _texts(shortest: int, bitmap):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            lines = list(dict.fromkeys(x for t in batch.column("text").to_pylist() for x in lines_of(t, shortest)[1]))
            ids = line_ids(lines)
            ids_list = ids.tolist()
            take = [i for i in np.flatnonzero(in_bitmap(bitmap.value, ids)).tolist() if ids_list[i] not in seen]
            seen.update(ids_list[i] for i in take)
            yield pa.RecordBatch.from_arrays([pa.array(ids[take]), pa.array([lines[i] for i in take], pa.string())], ["line", "text"])

    return emit


def _verify(steps: list[tuple[int, int | None, int]]):
    """Links between the lines of each block, as stars of the components inside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "part"):
            part, line = table.column("part").to_numpy(), table.column("line").to_numpy()
            tile = table.column("tile").to_numpy()
            across = table.column("tile_a").to_numpy() != table.column("tile_b").to_numpy()
            texts = table.column("text").to_pylist()
            size = np.array([len(t) for t in texts], np.int64)
            most = np.array([d for _, _, d in steps])[np.searchsorted([low for low, _, _ in steps], size, "right") - 1]
            at = np.cumsum(size) - size
            codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
            bins = np.repeat(np.arange(len(texts)), size) * 32 + (codes % 32).astype(np.int64)
            bag = np.bincount(bins, minlength=32 * len(texts)).reshape(-1, 32).astype(np.int32)
            root = np.arange(len(texts))

            def find(i: int) -> int:
                while root[i] != i:
                    root[i] = i = root[root[i]]
                return i

            waiting: list[tuple[np.ndarray, np.ndarray]] = []

            def settle() -> None:
                if not waiting:
                    return
                i, j = (np.concatenate(w) for w in zip(*waiting))
                waiting.clear()
                limit, near = np.minimum(most[i], most[j]), np.zeros(len(i), bool)
                for d in np.unique(limit):
                    own = limit == d
                    near[own] = within(codes, at, size, i[own], j[own], int(d))
                for a, b in zip(i[near].tolist(), j[near].tolist()):
                    a, b = find(a), find(b)
                    if a != b:
                        root[max(a, b)] = min(a, b)

            for start, many in zip(*runs(part)):
                stop = start + many
                for i0 in range(start, stop, 64):
                    i1 = min(stop, i0 + 64)
                    tops = np.array([find(i) for i in range(i0, i1)])
                    later = np.arange(i0 + 1, stop)
                    ok = np.abs(size[i0:i1, None] - size[later]) <= np.minimum(most[i0:i1, None], most[later])
                    ok &= later > np.arange(i0, i1)[:, None]
                    ok &= tops[:, None] != root[later]
                    if across[start]:
                        ok &= tile[i0:i1, None] != tile[later]
                    i, j = np.nonzero(ok)
                    i, j = i + i0, later[j]
                    for k in range(0, len(i), 65536):
                        a, b = i[k : k + 65536], j[k : k + 65536]
                        like = np.abs(bag[a] - bag[b]).sum(axis=1) <= 2 * np.minimum(most[a], most[b])
                        waiting.append((a[like], b[like]))
                    if sum(len(w[0]) for w in waiting) > 4096:
                        settle()
            settle()
            top = np.array([find(i) for i in range(len(texts))])
            hit = np.flatnonzero((line[top] != line))
            if len(hit):
                once = np.unique(np.stack([line[hit], line[top[hit]]], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(once[:, 0].copy()), pa.array(once[:, 1].copy())], ["a", "b"])

    return run


def near_lines(texts: DataFrame, steps: list[tuple[int, int | None, int]]) -> DataFrame:
    """``node, component`` of distinct lines linked by an edit distance of at most that of the shorter one's tier (see connected_components)."""
    if not any(distance for _, _, distance in steps):
        return texts.sparkSession.createDataFrame([], "node long, component long")
    shortest = min(low for low, _, distance in steps if distance)
    keyed = texts.mapInArrow(_keys(steps), "key long, line long, indexed boolean")
    shared = cut_lineage(keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_shared, "key long, line long"))
    bitmap = texts.sparkSession.sparkContext.broadcast(slot_bitmap(shared, "line"))
    found = texts.mapInArrow(_texts(shortest, bitmap), "line long, text string").dropDuplicates(["line"])
    blocks = cut_lineage(shared.join(found, "line"))
    tiles = blocks.groupBy("key").agg(F.ceil(F.sum(F.length("text").cast("long")) / TILE_CHARS).cast("int").alias("tiles")).filter("tiles > 1")
    placed = blocks.join(tiles, "key", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    placed = placed.withColumn("tile", F.pmod(F.xxhash64("line"), F.col("tiles").cast("long")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    placed = placed.withColumns({"tile_a": F.least("tile", "other"), "tile_b": F.greatest("tile", "other")})
    placed = placed.withColumn("part", F.xxhash64("key", "tile_a", "tile_b")).select("part", "tile", "tile_a", "tile_b", "line", "text")
    links = placed.repartition("part").sortWithinPartitions("part").mapInArrow(_verify(steps), "a long, b long")
    out = connected_components(links)
    release(shared, blocks)
    return out


def remove_near_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 2, shortest: int = 20, shorter: tuple[tuple[int, int], ...] = ()
) -> DataFrame:
    """Rows of ``docs`` with ``line_count, lines_removed, line_text``: the text without repeated lines.

    Lines are compared with runs of white space as one blank. Lines within the
    edit distance (in characters) link; of the lines that links connect, the one
    that comes first stays, by id (null last), then document, then place, and all
    others are removed, copies inside a document too. ``shorter`` holds lengths
    below ``shortest`` and the distance from there on (0: only exact repeats);
    of two lines the distance of the shorter one counts. Lines below all these
    lengths are left alone, and so are lines without characters. A text that loses no line comes back
    as it is: null stays null; one that loses all is empty. Rows that repeat id
    and text are one document and get the same text. Empty tables give no rows.
    Columns of ``docs`` named like the added ones are replaced by them; all others
    are kept whatever their names.

    Lines are identified by a 64-bit hash. Only lines that share a segment key
    with another are ever compared, block by block, a large block tile by tile.
    """
    steps = tiers(distance, shortest, shorter)
    docs, names = put_aside(docs, "_line", replaced=("line_count", "lines_removed", "line_text"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("doc", document_key("id", "text"))
    kind = dict(texts.dtypes)["id"]

    def list_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            found = [lines_of(t, max(1, steps[0][0])) for t in batch.column("text").to_pylist()]
            row = pa.array(np.repeat(np.arange(batch.num_rows), [len(f[0]) for f in found]))
            number = pa.array([i for f in found for i in f[0]], pa.int32())
            ids = pa.array(line_ids([x for f in found for x in f[1]]))
            yield pa.RecordBatch.from_arrays([ids, batch.column("doc").take(row), batch.column("id").take(row), number], ["line", "doc", "id", "number"])

    listed = cut_lineage(texts.mapInArrow(list_lines, f"line long, doc long, id {kind}, number int"))
    near = cut_lineage(near_lines(texts.select("text"), steps))
    place = F.struct(F.col("id").isNull().alias("nil"), "id", "doc", "number")
    firsts = listed.groupBy("line").agg(F.min(place).alias("least"), F.max(place).alias("most"))
    grouped = firsts.join(near, firsts["line"] == near["node"], "left").withColumn("top", F.coalesce("component", "line"))
    tops = near.select("component").distinct().withColumnRenamed("component", "top_line")
    several = grouped.join(tops, grouped["top"] == tops["top_line"], "left").filter("least != most or top_line is not null").select("line", "top", "least")
    several = cut_lineage(several)
    first = several.groupBy("top").agg(F.min("least").alias("first"))
    of_line = several.join(first, "top").select("line", F.col("first.doc").alias("at_doc"), F.col("first.number").alias("at_number"))
    later = listed.join(of_line, "line").filter((F.col("doc") != F.col("at_doc")) | (F.col("number") != F.col("at_number")))
    drop = later.groupBy("doc").agg(F.collect_set("number").alias("_line_drop")).withColumnRenamed("doc", "_line_doc")
    keyed = docs.withColumn("_line_key", document_key(id_col, text_col))
    out = keyed.join(drop, keyed["_line_key"] == drop["_line_doc"], "left")
    lines = F.split(F.col(text_col), "\n", -1)

    def without(x: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("_line_drop"))
        return F.array_join(F.transform(stay, lambda i: F.get(x, i)), "\n")

    # the lines are a variable, so a text is split once and not for each line
    kept = F.transform(F.array(lines), without)[0]
    text = F.when(F.col("_line_drop").isNull(), F.col(text_col)).otherwise(kept)
    return out.select(
        *[F.col(f"`{c}`").alias(names.get(c, c)) for c in docs.columns],
        F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.size(lines)).alias("line_count"),
        F.when(F.col("_line_drop").isNull(), F.lit(0)).otherwise(F.size("_line_drop")).alias("lines_removed"),
        text.alias("line_text"),
    )

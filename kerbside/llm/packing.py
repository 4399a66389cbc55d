"""Best-fit packing of tokenised documents into sequences of a fixed size.

Documents longer than a sequence are cut into full pieces and a rest. The
lengths of all pieces make a histogram of at most ``CAPACITY`` counts, over which
the configuration linear program is solved: cover every length's count with as
few configurations (sets of lengths that fit one sequence) as possible.
Multiplicative weights act as prices of the lengths. A round prices by a
knapsack dynamic program over the sequence, takes for every length the best
configuration that holds it, adds a share of those near the optimum and lowers
the prices of what they cover, until every length is covered. The prices also
bound any packing from below. The fractional counts are rounded down, fullest
configurations first; further rounds of the same pricing take whole
configurations off what remains, and the last of it is packed best-fit over
groups of equally filled sequences. The histogram, the prices
and the plan have sizes that do not grow with the number of documents.

Each piece gets a rank among the pieces of its length, and the plan says which
ranks of a length fill which sequences at which offset.

Defined cases: a null or empty text is the end mark alone; repeated rows are
packed each; a null id is kept; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.tables import stored
from kerbside.llm.word_merges import WordMerges

CAPACITY = 4096
END_ID = 1
ROUNDS = 150
NEAR, PEEL = 0.0005, 0.002
STEP = 0.5
LONGER = 1e-4
LITTLE = 0.05
SLACK = 4  # tokens that a configuration of the rounded program may leave free
BOUND_EVERY = 6
MOST_CACHED = 400_000
GROUP_TEXTS = 512
GROUP_ROWS = 256
MOST_GROUPS = 1 << 16


class ChunkTokens(dict):
    """Token ids of stretches without blanks, as little-endian bytes; each is encoded once while the cache lasts.

    The tokenizer drops white space and none of its steps looks across it, so
    a text's ids are those of its stretches in order. In a text of Latin
    letters and ASCII, which the tokenizer only lowers, marks between a letter
    and a blank are a stretch of their own, so the words of a language are few.
    Words of letters alone are merged many at a time; other missing stretches
    are encoded by the tokenizer, with a stretch of one known id between them.
    """

    MARK = "|"
    LETTERS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u024F"
    OTHER = re.compile(f"[^\t\n\r -~{LETTERS}]")
    WORD = re.compile(f"[{LETTERS}]+")
    # Not those that end the name of a special token.
    LAST_MARKS = re.compile(f"(?<=[{LETTERS}])([!-/:;<=?@\\[-`{{}}~]+)(?=[ \t\n\r]|$)")

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.whole, self.words = Tokenizer.from_file(path), WordMerges(path)
        [self.mark] = self.whole.encode(self.MARK, add_special_tokens=False).ids

    def stretches(self, text: str) -> list[str]:
        if not self.OTHER.search(text):
            text = self.LAST_MARKS.sub(r" \1", text.lower())
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")

    def learn(self, missing: set[str]) -> None:
        """Add what is missing."""
        words = [c for c in missing if c.isalpha() and c.islower() and self.WORD.fullmatch(c)]
        self.update(zip(words, self.words.encode(words), strict=True))
        self._encode_each(self.whole, list(missing.difference(words, [""])), self)
        self[""] = b""

    def _encode_each(self, tokenizer, missing: list[str], into: dict[str, bytes]) -> None:
        def encode(text: str) -> np.ndarray:
            [found] = tokenizer.encode_batch_fast([text], add_special_tokens=False)
            return np.array(found.ids, "<u4")

        for chunk in [c for c in missing if self.MARK in c]:
            into[chunk] = encode(chunk).tobytes()
        plain = [c for c in missing if self.MARK not in c]
        for at in range(0, len(plain), 4096):
            some = plain[at : at + 4096]
            ids = encode(f" {self.MARK} ".join(some))
            ends = np.r_[np.flatnonzero(ids == self.mark), len(ids)]
            data, start = ids.tobytes(), 0
            for chunk, end in zip(some, ends.tolist(), strict=True):
                into[chunk] = data[4 * start : 4 * end]
                start = end + 1

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text. What a group of texts lacks is learnt at once."""
        for at in range(0, len(texts), GROUP_TEXTS):
            group = [self.stretches(t or "") for t in texts[at : at + GROUP_TEXTS]]
            wanted = set().union(*group)
            missing = {c for c in wanted if c not in self}
            if len(self) + len(missing) > MOST_CACHED:
                # A full cache is emptied; what these texts need is learnt again.
                self.clear()
                missing = wanted
            self.learn(missing)
            for chunks in group:
                yield b"".join(map(self.__getitem__, chunks))


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: id, piece, start, length and ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ChunkTokens(tokenizer_path)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            owner, piece, start, size, crc = [], [], [], [], []
            for row, ids in enumerate(tokens.ids(batch.column(1).to_pylist())):
                data = ids + end
                for number, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    owner.append(row)
                    piece.append(number)
                    start.append(at // 4)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                [id_col, "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long")


# --- the plan over the histogram ------------------------------------------------------


def _knapsack(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best total price within each capacity, and the last item taken (-1: none). ``sizes`` ascend."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        taken[room] = taken[room - 1]
        n = fitting[room]
        if n:
            worth = best[room - sizes[:n]] + prices[:n]
            at = int(worth.argmax())
            if worth[at] > best[room] + 1e-12:
                best[room], taken[room] = worth[at], at
    return best, taken


def _configurations(best: np.ndarray, taken: np.ndarray, prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every length the best configuration with it: values and items (-1 padded)."""
    room = capacity - sizes
    columns = [np.arange(len(sizes))]
    while True:
        item = taken[room]
        if (item < 0).all():
            return prices + best[capacity - sizes], np.stack(columns, 1)
        columns.append(item)
        room = np.where(item >= 0, room - sizes[np.maximum(item, 0)], 0)


def _priced(sizes: np.ndarray, weight: np.ndarray, capacity: int, near: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Each length's best configuration, the lengths whose one is near the best (longest first), and what the best is worth."""
    # Of equally worthy configurations those of longer pieces win, so the short ones are there to fill gaps at the end.
    prices = sizes / capacity * (1 + LONGER * sizes / capacity) * np.exp(weight - weight.max())
    best, taken = _knapsack(prices, sizes, capacity)
    values, items = _configurations(best, taken, prices, sizes, capacity)
    chosen = np.flatnonzero(values >= (1 - near) * values.max())
    return items, chosen[np.argsort(-sizes[chosen], kind="stable")], float(values.max())


def fractional_cover(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[dict[tuple[int, ...], float], float]:
    """Configurations (sorted item numbers) with how often to use them, and a lower bound on any packing.

    After a round the weight of a length grows with the share of its demand
    that is still open. What counts as near the best widens when a round covers
    little, so every length is covered in the end. Any prices bound the program
    from below: what all pieces are worth over what one sequence can be worth.
    """
    use: dict[tuple[int, ...], float] = {}
    covered, weight = np.zeros(len(sizes)), np.zeros(len(sizes))
    bound, near = float(sizes @ demand) / capacity, NEAR
    for turn in range(rounds):
        lag = np.maximum(0.0, 1 - covered / demand)
        open_ = np.flatnonzero(lag > 1e-9)
        if not len(open_):
            break
        if turn % BOUND_EVERY == BOUND_EVERY - 1:
            prices = sizes / capacity * np.exp(weight - weight.max())
            bound = max(bound, float(prices @ demand) / float(_knapsack(prices, sizes, capacity)[0][capacity]))
        items, rows, _ = _priced(sizes[open_], weight[open_], capacity, near if turn < rounds - 1 else 1.0)
        before = float(sizes @ covered)
        for row in rows:
            kinds, count = np.unique(open_[items[row][items[row] >= 0]], return_counts=True)
            left = (demand - covered)[kinds] / count
            if turn < rounds - 1:
                amount = min(float(left.min()), max(1.0, float(demand[open_[row]]) / 4))
            else:
                # What is still open is covered whatever else a configuration covers again.
                amount = float(left[kinds == open_[row]][0])
            if amount <= 1e-9:
                continue
            covered[kinds] += amount * count
            key = tuple(np.repeat(kinds, count).tolist())
            use[key] = use.get(key, 0.0) + amount
        lag = np.maximum(0.0, 1 - covered / demand)
        weight += STEP * (lag - lag.mean())
        if float(sizes @ covered) - before < LITTLE * (float(sizes @ demand) - before):
            near = min(1.0, 2 * near)
    return use, bound


def _peeled(sizes: np.ndarray, demand: np.ndarray, left: np.ndarray, capacity: int, rounds: int) -> list[tuple[dict[int, int], int]]:
    """Whole configurations out of what is left, by the same prices; takes them off ``left``."""
    plan: list[tuple[dict[int, int], int]] = []
    for _ in range(rounds):
        open_ = np.flatnonzero(left > 0)
        if not len(open_):
            break
        items, rows, _ = _priced(sizes[open_], STEP * (left / demand)[open_], capacity, PEEL)
        before = len(plan)
        for row in rows:
            kinds, count = np.unique(open_[items[row][items[row] >= 0]], return_counts=True)
            times = int((left[kinds] // count).min())
            if times > 0 and int(sizes[kinds] @ count) >= capacity - SLACK:
                left[kinds] -= times * count
                plan.append(({int(k): int(c) for k, c in zip(kinds, count, strict=True)}, times))
        if len(plan) == before:
            break
    return plan


def _best_fit(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Longest first into the fullest sequence with room, over groups of equally filled sequences."""
    rooms: list[list[list]] = [[] for _ in range(capacity + 1)]  # by room left: [contents, number]
    held = np.zeros(capacity + 1, np.int64)

    def put(room: int, contents: dict[int, int], number: int) -> None:
        if number:
            rooms[room].append([contents, number])
            held[room] += number

    for item in range(len(sizes) - 1, -1, -1):
        size, left = int(sizes[item]), int(demand[item])
        while left:
            open_ = np.flatnonzero(held[size:])
            if not len(open_):
                each = capacity // size
                put(capacity - each * size, {item: each}, left // each)
                if left % each:
                    put(capacity - (left % each) * size, {item: left % each}, 1)
                break
            room = size + int(open_[0])
            contents, number = rooms[room].pop()
            held[room] -= number
            used = min(number, left)
            put(room, contents, number - used)
            put(room - size, {**contents, item: contents.get(item, 0) + 1}, used)
            left -= used
    return [(contents, number) for groups in rooms for contents, number in groups]


def packing_plan(sizes: np.ndarray, demand: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """``(lengths with their counts, number of sequences)`` that hold exactly the histogram. ``sizes`` ascend."""
    return bounded_plan(sizes, demand, capacity, rounds)[0]


def bounded_plan(sizes: np.ndarray, demand: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> tuple[list[tuple[dict[int, int], int]], float]:
    """The plan, and the program's lower bound on the number of sequences."""
    plan: list[tuple[dict[int, int], int]] = []
    left, bound = demand.astype(np.int64).copy(), 0.0
    if len(sizes) and sizes[-1] == capacity:
        plan.append(({capacity: 1}, int(left[-1])))
        bound = float(left[-1])
        left[-1] = 0
    short = sizes < capacity
    if short.any():
        small, asked = sizes[short], demand[short].astype(np.int64)
        use, least = fractional_cover(small, asked.astype(float), capacity, rounds)
        bound += least
        rest, found = asked.copy(), []
        fill = {key: int(small[list(key)].sum()) for key in use}
        for key in sorted(use, key=lambda c: (-fill[c], -use[c], c)):
            kinds, count = np.unique(key, return_counts=True)
            times = min(int(use[key] + 1e-9), int((rest[kinds] // count).min()))
            if times > 0 and fill[key] >= capacity - SLACK:
                rest[kinds] -= times * count
                found.append(({int(k): int(c) for k, c in zip(kinds, count, strict=True)}, times))
        found += _peeled(small, asked, rest, capacity, rounds)
        found += _best_fit(small, rest, capacity)
        plan += [({int(small[k]): c for k, c in contents.items()}, number) for contents, number in found]
    return plan, bound


def _runs(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, pieces per sequence, first sequence, offset), ranks ascending."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for contents, number in plan:
        offset = 0
        for size in sorted(contents, reverse=True):
            each = contents[size]
            runs.setdefault(size, []).append((used.get(size, 0), each, sequence, offset))
            used[size] = used.get(size, 0) + each * number
            offset += each * size
        sequence += number
    return {size: np.array(rows, np.int64) for size, rows in runs.items()}


# --- ranks and places -----------------------------------------------------------------


def packed(pieces: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Stored pieces plus sequence_id and offset. Give a stored table: it is read several times."""
    spark = pieces.sparkSession
    rows = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    if not rows:
        return pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    sizes = np.array(sorted(r["length"] for r in rows), np.int64)
    count = {r["length"]: r["count"] for r in rows}
    demand = np.array([count[s] for s in sizes], np.int64)
    runs = _runs(packing_plan(sizes, demand, capacity))

    # Ranks within a length: numbered in groups of bounded size, whose offsets are summed here
    # (at most capacity + MOST_GROUPS groups). A length that a third of all pieces share is many groups.
    per_group = max(GROUP_ROWS, int(demand.sum()) // MOST_GROUPS)
    shares = spark.createDataFrame([(int(s), int(-(-d // per_group))) for s, d in zip(sizes, demand, strict=True)], "length long, shares int")
    salted = pieces.join(F.broadcast(shares), "length").withColumn(
        "share", F.pmod(F.xxhash64(id_col, "piece", "start", "ids_crc32"), F.col("shares")).cast("int")
    ).drop("shares")
    totals = salted.groupBy("length", "share").count().collect()
    before: dict[tuple[int, int], int] = {}
    at: dict[int, int] = {}
    for r in sorted(totals, key=lambda r: (r["length"], r["share"])):
        before[r["length"], r["share"]] = at.get(r["length"], 0)
        at[r["length"]] = at.get(r["length"], 0) + r["count"]
    shared = spark.sparkContext.broadcast((runs, before))
    order = Window.partitionBy("length", "share").orderBy(id_col, "piece")
    columns = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size, offsets = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            share, place = batch.column("share").to_numpy(), batch.column("__place").to_numpy()
            rank = place - 1 + np.fromiter((offsets[k] for k in zip(length.tolist(), share.tolist(), strict=True)), np.int64, len(length))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for size in np.unique(length):
                mine = np.flatnonzero(length == size)
                table = by_size[int(size)]
                hit = table[np.searchsorted(table[:, 0], rank[mine], side="right") - 1]
                inside = rank[mine] - hit[:, 0]
                sequence[mine] = hit[:, 2] + inside // hit[:, 1]
                offset[mine] = hit[:, 3] + inside % hit[:, 1] * size
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"]
            )

    schema = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in columns)
    ranked = salted.withColumn("__place", F.row_number().over(order).cast("long"))
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): where it starts and where it is placed."""
    return packed(stored(tokenised_pieces(docs, tokenizer_path, capacity=capacity), "pieces"), capacity=capacity)

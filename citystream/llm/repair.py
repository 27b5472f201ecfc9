"""Conversation structure repair (operator 13) by a grammar-compressed DP.

A conversation's rows, in order, are a sequence of symbols: the role's initial
and the row's fault (none, blank, duplicate, truncated). A repair keeps, reroles
or deletes each row and may insert empty ones, so that the initials give
`(s?(ua)+)?`. The pattern has four states, so a symbol is a 4 x 4 matrix: its
entry (i, j) is the cheapest cost of taking the row (and inserting before it) from state i
to state j, with the edits as an audit rope. Matrices multiply in the min-plus
sense, ropes being joined; of equal costs the audit that is least as text counts.
Equal costs never belong to audits of which one begins the other (what is longer
has more inserts), so the least audit of a whole is made of least audits of its parts.

Sequences are compressed with Re-Pair: in rounds, Spark counts adjacent pairs
over all distinct sequences, the most frequent ones become rules, and sequences
are rewritten. Each rule has one matrix, evaluated bottom-up from those of its two
symbols, and is shared by all conversations. A rule only saves work: whatever is
left uncompressed after RULES rules is multiplied symbol by symbol.

How it runs: rows without their texts are sorted by range, so a conversation that
holds a third of all rows is laid out by many tasks, as chunks of at most CHUNK
symbols; the chunks are folded in order by a stream of batches that carries four
states. Texts are moved once, to their conversation, behind its audit; the edits
run over the sorted stream, and so does what reads them (a digest is a chain over a
whole conversation, so that one is one task's stream, in batches).

Defined results: a null role or text counts as one space, so does a null
conversation or turn in the damage's key; rows without conversation are one
conversation; rows of one turn go by a hash of role and text; rows without turn
come first; repeated rows are duplicates; roles that begin with none of s, u, a (or are empty) fit
nowhere; a conversation of which no row is left has zeros, no audit
and the digest of the empty text; more gaps than a long holds are given as the largest one; an empty table gives an empty result; other columns are
ignored. Equal role and text are told by MD5. Very long texts are read whole."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citystream.llm import arrowtext as A
from citystream.session import shared_root

#: Symbols of a chunk of one sequence.
CHUNK = 4096
#: Rules of the grammar, and those that one round adds.
RULES, ROUND = 128, 32
#: Sequences whose repair a task remembers.
REMEMBERED = 50_000

# Costs of the edits, and faults.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
OK, BLANK, DUPLICATE, CUT_OFF = range(4)
INITIALS = "sua"  # others are the fourth kind
LEGAL = {(0, 1), (1, 2), (2, 1)}  # su, ua, au
#: States of the pattern: at the start, after s, after u, after a. Moves by initial.
MOVES = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
ENDS = (0, 3)
RULE_SYMBOL = 0x100
SPACES = " \t\n\x0b\f\r"
LEAST_TURN, MOST = -2 ** 63 - 1, 2 ** 63 - 1


def symbol(initial: int, fault: int) -> str:
    return chr(ord("A") + 4 * initial + fault)


class Rope:
    """An audit: text, or two ropes, with its length and a hash of its text."""

    __slots__ = ("text", "left", "right", "size", "mark")
    BASE, PRIME = 911382323, (1 << 61) - 1

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if text is not None:
            self.size = len(text)
            self.mark = reduce(lambda h, c: (h * self.BASE + ord(c)) % self.PRIME, text, 0)
        else:
            self.size = left.size + right.size
            self.mark = (left.mark * pow(self.BASE, right.size, self.PRIME) + right.mark) % self.PRIME

    def __add__(self, other: Rope) -> Rope:
        return other if not self.size else self if not other.size else Rope(None, self, other)

    def __lt__(self, other: Rope) -> bool:
        """As texts compare; parts that are the same are passed over whole."""
        mine, theirs = [self], [other]
        while mine and theirs:
            a, b = mine.pop(), theirs.pop()
            if a is b or (a.size == b.size and a.mark == b.mark):
                continue
            if a.text is None and (b.text is not None or a.size >= b.size):
                mine += [a.right, a.left]
                theirs.append(b)
            elif b.text is None:
                theirs += [b.right, b.left]
                mine.append(a)
            else:
                n = min(a.size, b.size)
                if a.text[:n] != b.text[:n]:
                    return a.text < b.text
                mine += [Rope(a.text[n:])] if a.size > n else []
                theirs += [Rope(b.text[n:])] if b.size > n else []
        return bool(theirs) and not mine

    def __str__(self) -> str:
        out, left = [], [self]
        while left:
            rope = left.pop()
            if rope.text is not None:
                out.append(rope.text)
            else:
                left += [rope.right, rope.left]
        return "".join(out)


NOTHING = Rope("")
#: A vector or a matrix' row: state -> (cost, audit).
Row = dict[int, tuple[int, Rope]]


def times(row: Row, matrix: tuple[Row, ...]) -> Row:
    out: Row = {}
    for k, (cost, audit) in row.items():
        for j, (more, edits) in matrix[k].items():
            known = out.get(j)
            total = cost + more
            if known is None or total < known[0]:
                out[j] = (total, audit + edits)
            elif total == known[0]:
                whole = audit + edits
                if whole < known[1]:
                    out[j] = (total, whole)
    return out


def product(a: tuple[Row, ...], b: tuple[Row, ...]) -> tuple[Row, ...]:
    return tuple(times(row, b) for row in a)


def inserts() -> tuple[Row, ...]:
    """From each state to those that inserted rows lead to, by the fewest."""
    out = []
    for start in range(4):
        row, at, n = {start: (0, NOTHING)}, [start], 0
        while at:
            n += 1
            at = [j for i in at for initial in (1, 2) for j in (MOVES[initial].get(i),) if j is not None and j not in row]
            row |= {j: (INSERT * n, Rope("I" * n)) for j in at}
        out.append(row)
    return tuple(out)


INSERTS = inserts()


class Part:
    """What a run of rows is to a repair: matrix, kinds of its first and last row, illegal
    neighbours within, and rows by fault."""

    __slots__ = ("matrix", "first", "last", "illegal", "faults")

    def __init__(self, matrix, first, last, illegal, faults):
        self.matrix, self.first, self.last, self.illegal, self.faults = matrix, first, last, illegal, faults

    def __add__(self, other: Part) -> Part:
        return Part(product(self.matrix, other.matrix), self.first, other.last, self.illegal + other.illegal + ((self.last, other.first) not in LEGAL),
                    tuple(a + b for a, b in zip(self.faults, other.faults)))


def single(initial: int, fault: int) -> Part:
    rows: list[Row] = [{i: (DELETE, Rope("D"))} for i in range(4)]
    if fault in (OK, CUT_OFF):
        more = TRUNCATED if fault == CUT_OFF else 0
        edits = [(kind, REROLE + more, Rope("R")) for kind in (1, 2)] + [(initial, more, Rope("K"))]
        for kind, cost, audit in edits:
            for i, j in MOVES[kind].items():
                if j not in rows[i] or cost < rows[i][j][0]:
                    rows[i][j] = (cost, audit)
    return Part(product(INSERTS, tuple(rows)), initial, initial, 0, tuple(int(fault == k) for k in range(4)))


@lru_cache(maxsize=4)
def parts(rules: tuple[str, ...]) -> dict[str, Part]:
    """The part of each symbol; rule k stands for the two symbols rules[k], which are earlier ones."""
    known = {symbol(i, f): single(i, f) for i in range(4) for f in range(4)}
    for k, (a, b) in enumerate(rules):
        known[chr(RULE_SYMBOL + k)] = known[a] + known[b]
    return known


def compressed(sequence: str, rules: tuple[str, ...]) -> str:
    for k, pair in enumerate(rules):
        sequence = sequence.replace(pair, chr(RULE_SYMBOL + k))
    return sequence


class Fold:
    """The repair of one conversation, fed with its chunks in order."""

    def __init__(self):
        self.row: Row = {0: (0, NOTHING)}
        self.last: int | None = None
        self.illegal, self.faults = 0, [0, 0, 0, 0]

    def feed(self, symbols: str, known: dict[str, Part]) -> None:
        for s in symbols:
            part = known[s]
            self.illegal += part.illegal + (self.last is not None and (self.last, part.first) not in LEGAL)
            self.last = part.last
            self.row = times(self.row, part.matrix)
            for k, n in enumerate(part.faults):
                self.faults[k] += n

    def report(self) -> tuple:
        """blank, duplicate, truncated, illegal, cost, audit."""
        ends = times(self.row, INSERTS)
        cost, audit = min((ends[j] for j in ENDS if j in ends), key=lambda x: (x[0], str(x[1])))
        return (*self.faults[1:], self.illegal, cost, str(audit))


# ------------------------------------------------------------ rows and their symbols

def _blankless(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACES))


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, copies: rows spoilt by the remainder of a checksum of their key."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), said(role_col).alias("role"), said(text_col).alias("text"),
                                (F.crc32(F.concat(said(conv_col), F.lit(":"), said(turn_col))) % 20).alias("fate")).filter("fate != 0")
    text = F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.when(F.col("fate") == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"))


def _keyed(rows: DataFrame) -> list[Column]:
    """Key of the conversation, turn in order, hash of role and text."""
    role = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return [F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("c"), F.coalesce(F.col("turn").cast("decimal(20,0)"), F.lit(Decimal(LEAST_TURN)).cast("decimal(20,0)")).alias("t"),
            F.unhex(F.md5(role)).alias("m")]


def _runs(rows: DataFrame) -> DataFrame:
    """c, t, m, initial, fault, n, first: equal rows of a turn as one, with their number; `first` if
    none of an earlier turn equals them."""
    start = F.substring("role", 1, 1)
    initial = F.when(start == "s", 0).when(start == "u", 1).when(start == "a", 2).otherwise(3)
    end = _blankless(F.col("text"))
    fault = F.when(end == "", BLANK).when(F.right(end, F.lit(1)).isin(".", "!", "?"), OK).otherwise(CUT_OFF)
    own = rows.select(*_keyed(rows), initial.alias("initial"), fault.alias("fault"), "copies")
    own = own.groupBy("c", "t", "m", "initial", "fault").agg(F.sum("copies").alias("n"))
    again = own.groupBy("c", "m").agg(F.min("t").alias("t0"), F.count("*").alias("turns")).filter("turns > 1").select("c", "m", "t0")
    return own.join(again, ["c", "m"], "left").select("c", "t", "m", "initial", "fault", "n", (F.col("t0").isNull() | (F.col("t") == F.col("t0"))).alias("first"))


def chunks(runs: DataFrame) -> DataFrame:
    """c, part, i, symbols: the sequence of each conversation, cut where a range of the sort or a chunk ends."""

    most = CHUNK

    def lay(batches):
        part, i, name, held, size = TaskContext.get().partitionId(), 0, None, [], 0
        rows: list[tuple] = []

        def flush() -> None:
            nonlocal i, held, size
            if size:
                rows.append((name, part, i, "".join(held)))
                i, held, size = i + 1, [], 0

        for batch in batches:
            for c, initial, fault, n, first in zip(*(A.column(batch, x).to_pylist() for x in ("c", "initial", "fault", "n", "first"))):
                if c != name:
                    flush()
                    name, i = c, 0
                again = BLANK if fault == BLANK else DUPLICATE
                left = [(fault if first else again, 1), (again, n - 1)]
                for kind, many in left:
                    while many:
                        k = min(many, most - size)
                        held.append(symbol(initial, kind) * k)
                        size, many = size + k, many - k
                        if size == most:
                            flush()
            yield _batch(rows, (pa.string(), pa.int32(), pa.int64(), pa.string()), ("c", "part", "i", "symbols"))
            rows = []
        flush()
        yield _batch(rows, (pa.string(), pa.int32(), pa.int64(), pa.string()), ("c", "part", "i", "symbols"))

    laid = runs.repartitionByRange("c", "t", "m").sortWithinPartitions("c", "t", "m")
    return laid.select("c", "initial", "fault", "n", "first").mapInArrow(lay, "c string, part int, i long, symbols string")


def _batch(rows: list[tuple], types: tuple, names: tuple[str, ...]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))


def grammar(sequences: DataFrame) -> tuple[str, ...]:
    """Rules of the distinct sequences (`symbols`), the most frequent pairs of each round first."""
    now, rules = sequences.select("symbols").distinct(), []
    while len(rules) < RULES:
        now = now.filter(F.length("symbols") > 1).checkpoint()
        ends = F.sequence(F.lit(1), F.length("symbols") - 1)
        pairs = now.select(F.explode(F.transform(ends, lambda k: F.substring(F.col("symbols"), k, F.lit(2)))).alias("pair")).groupBy("pair").count().filter("count > 1")
        best = [r["pair"] for r in pairs.orderBy(F.col("count").desc(), "pair").limit(min(ROUND, RULES - len(rules))).collect()]
        if not best:
            break
        text = F.col("symbols")
        for pair in best:
            text = F.replace(text, F.lit(pair), F.lit(chr(RULE_SYMBOL + len(rules))))
            rules.append(pair)
        now = now.select(text.alias("symbols")).distinct()
    return tuple(rules)


REPORT = "c string, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def folded(laid: DataFrame, rules: tuple[str, ...]) -> DataFrame:
    """c, blank, duplicate, truncated, illegal, cost, audit of each conversation's chunks."""

    def fold(batches):
        known, seen = parts(rules), {}
        now, name, only = Fold(), None, None  # only: the sequence, while it is a single chunk
        rows: list[tuple] = []

        def close() -> None:
            if name is None:
                return
            if only is None:
                rows.append((name, *now.report()))
                return
            if only not in seen:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                one = Fold()
                one.feed(compressed(only, rules), known)
                seen[only] = one.report()
            rows.append((name, *seen[only]))

        types = (pa.string(), *[pa.int64()] * 5, pa.string())
        names = ("c", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
        for batch in batches:
            for c, symbols in zip(A.column(batch, "c").to_pylist(), A.column(batch, "symbols").to_pylist()):
                if c != name:
                    close()
                    now, name, only = Fold(), c, symbols
                    continue
                if only is not None:
                    now.feed(compressed(only, rules), known)
                    only = None
                now.feed(compressed(symbols, rules), known)
            yield _batch(rows, types, names)
            rows = []
        close()
        yield _batch(rows, types, names)

    return laid.repartition("c").sortWithinPartitions("c", "part", "i").select("c", "symbols").mapInArrow(fold, REPORT)


def reports(rows: DataFrame) -> DataFrame:
    """c, gaps, blank, duplicate, truncated, illegal, cost, audit of each conversation of rows
    (conv_id, turn, role, text, copies)."""
    shared_root(rows.sparkSession)
    runs = _runs(rows)
    laid = chunks(runs).checkpoint()
    turns = F.when(F.col("t") > F.lit(Decimal(LEAST_TURN)), F.col("t"))
    missing = F.least(F.max(turns) - F.min(turns) + 1 - F.count_distinct(turns), F.lit(Decimal(MOST)))
    gaps = runs.groupBy("c").agg(F.when(F.max(turns).isNotNull(), missing.cast("long")).otherwise(F.lit(0)).alias("gaps"))
    return folded(laid, grammar(laid)).join(gaps, "c")


# ------------------------------------------------------------ repaired rows

class Editor:
    """Applies an audit to a conversation's rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, 0
        self.odd = (len(audit) - audit.count("D")) % 2  # an odd number of rows begins with s

    def role(self) -> str:
        return "user" if (self.place - self.odd) % 2 == 0 else "assistant"

    def inserted(self) -> Iterator[tuple[int, str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield self.place, self.role(), "", "I"
            self.at, self.place = self.at + 1, self.place + 1

    def take(self, role: str, text: str) -> Iterator[tuple[int, str, str, str]]:
        """Rows (place, role, text, edit) that the next row gives."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self.place, role if edit == "K" else self.role(), text, edit
            self.place += 1


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """c, place, role, text, edit: the rows of all repaired conversations. A partition holds whole
    conversations, in order."""
    texts = rows.select(*_keyed(rows), "role", "text", "copies", F.lit(None).cast("string").alias("audit"))
    audits = found.select("c", F.lit(None).cast("decimal(20,0)").alias("t"), F.lit(None).cast("binary").alias("m"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
                          F.lit(0).alias("copies"), "audit")
    types, names = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()), ("c", "place", "role", "text", "edit")

    def edit(batches):
        editor, name = Editor(""), None
        for batch in batches:
            for part, _ in A.slices(batch):
                out: list[tuple] = []
                for c, role, text, copies, audit in zip(*(A.column(part, x).to_pylist() for x in ("c", "role", "text", "copies", "audit"))):
                    if c != name:  # the audit comes first
                        out += [(name, *r) for r in editor.inserted()]
                        editor, name = Editor(audit), c
                    for _ in range(copies):
                        out += [(c, *r) for r in editor.take(role, text)]
                yield _batch(out, types, names)
        yield _batch([(name, *r) for r in editor.inserted()], types, names)

    whole = texts.unionByName(audits).repartition("c").sortWithinPartitions("c", F.col("t").asc_nulls_first(), "m")
    return whole.mapInArrow(edit, "c string, place long, role string, text string, edit string")


def digested(edited: DataFrame) -> DataFrame:
    """c, repaired_sha256 of conversations that have rows left, from `repaired`'s partitions."""

    def chain(batches):
        name, state, out = None, None, []
        for batch in batches:
            for c, role, text in zip(*(A.column(batch, x).to_pylist() for x in ("c", "role", "text"))):
                if c != name:
                    if name is not None:
                        out.append((name, state.hexdigest()))
                    name, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            yield _batch(out, (pa.string(), pa.string()), ("c", "repaired_sha256"))
            out = []
        if name is not None:
            yield _batch([(name, state.hexdigest())], (pa.string(), pa.string()), ("c", "repaired_sha256"))

    return edited.select("c", "role", "text").mapInArrow(chain, "c string, repaired_sha256 string")


def audits(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation, after damage."""
    rows = damaged(conversations, conv_col, turn_col, role_col, text_col)
    found = reports(rows).checkpoint()
    every = conversations.select(F.col(conv_col).cast("long").alias("conv_id")).distinct().withColumn("c", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    out = every.join(found, "c", "left").join(digested(repaired(rows, found)), "c", "left")
    numbers = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))

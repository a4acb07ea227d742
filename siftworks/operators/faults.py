"""Planting known faults in a good table, to test rules against.

Rows are picked by the residue of a key, so that a run, a retry and another
partitioning damage the same rows, and the answer key follows from the key
column without being stored.  Picks and damages are SQL expressions: a fault
plan is text that can be read, printed and kept in a file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLANTED = "planted"


def literal(text: str | None) -> str:
    """A SQL string literal."""
    if text is None:
        return "CAST(NULL AS STRING)"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def one_of(values: Sequence[str], chooser: str) -> str:
    """The value at the chooser's residue: spreads a list over the rows."""
    listed = ", ".join(literal(v) for v in values)
    return f"element_at(array({listed}), CAST(pmod({chooser}, {len(values)}) + 1 AS INT))"


@dataclass(frozen=True)
class Pick:
    """Rows whose key leaves one of the residues, unless another pick has them.

    ``rows`` reads the columns that ``with_residues`` adds.
    """

    modulus: int
    residues: tuple[int, ...]
    unless: Pick | None = None

    def rows(self) -> str:
        hit = f"_mod_{self.modulus} IN ({', '.join(map(str, self.residues))})"
        return f"({hit} AND NOT {self.unless.rows()})" if self.unless else f"({hit})"


def with_residues(df: DataFrame, key: str, moduli: Sequence[int]) -> DataFrame:
    """Add the residues of the key once, for all picks after it.

    Spelled out in every pick they would swell the generated code beyond what
    the JVM compiles.  A key that is no whole number is hashed.
    """
    whole = dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint")
    number = key if whole else f"xxhash64({key})"
    return df.withColumns({f"_mod_{m}": F.expr(f"CAST(pmod({number}, {m}) AS INT)") for m in moduli})


@dataclass(frozen=True)
class Fault:
    """One kind of damage: the rows, the columns, and the new value of each.

    ``damage`` is an expression in which ``{value}`` stands for the damaged
    column.  ``error_type`` goes into the answer key, with ``logged_column``
    where that is not the damaged column; a fault without one is planted
    silently.
    """

    error_type: str | None
    columns: tuple[str, ...]
    pick: Pick
    damage: str
    logged_column: str | None = None

    def branch(self, column: str) -> str:
        return f"WHEN {self.pick.rows()} THEN {self.damage.format(value=column)}"

    def entry(self) -> str:
        """The answer-key entry of a row, NULL for rows not picked."""
        where = literal(self.logged_column or ", ".join(self.columns))
        what = literal(self.error_type)
        return (
            f"CASE WHEN {self.pick.rows()} "
            f"THEN named_struct('column', {where}, 'error_type', {what}) END"
        )


def inject(df: DataFrame, faults: Sequence[Fault]) -> DataFrame:
    """Damage the picked rows, in one projection.

    Where faults of one call meet in a column, the first in the list wins;
    faults that must act on top of others go into a later call.
    """
    damaged = {
        column: F.expr(
            f"CASE {' '.join(f.branch(column) for f in faults if column in f.columns)} "
            f"ELSE {column} END"
        )
        for column in dict.fromkeys(c for f in faults for c in f.columns)
    }
    return df.withColumns(damaged)


def write_in_formats(
    df: DataFrame,
    columns: Mapping[str, str],
    formats: Sequence[tuple[Pick, str]],
    otherwise: str,
) -> DataFrame:
    """Write timestamps as text; each row uses one format for all its columns.

    ``columns`` maps the new text columns to the timestamps they are made of.
    """

    def written(source: str) -> str:
        branches = [
            f"WHEN {pick.rows()} THEN date_format({source}, {literal(pattern)})"
            for pick, pattern in formats
        ]
        usual = f"date_format({source}, {literal(otherwise)})"
        return f"CASE {' '.join(branches)} ELSE {usual} END" if branches else usual

    return df.withColumns({new: F.expr(written(source)) for new, source in columns.items()})


def log_faults(df: DataFrame, faults: Sequence[Fault]) -> DataFrame:
    """Add the array of answer-key entries that each row carries."""
    entries = ", ".join(f.entry() for f in faults if f.error_type)
    return df.withColumn(PLANTED, F.expr(f"array_compact(array({entries}))"))


def add_copies(df: DataFrame, pick: Pick, as_column: str = "copy") -> DataFrame:
    """Append an exact copy of the picked rows: 0 marks originals, 1 copies.

    Rows are doubled in place, which reads the input once; a union of the
    table and its picked rows would read it twice.
    """
    numbers = f"CASE WHEN {pick.rows()} THEN array(0, 1) ELSE array(0) END"
    return df.withColumn(as_column, F.explode(F.expr(numbers)))


def append_copies(df: DataFrame, pick: Pick) -> DataFrame:
    """The same rows as ``add_copies`` by a union, for inputs that are cheap to
    read twice."""
    copies = df.filter(pick.rows()).withColumn("copy", F.lit(1))
    return df.withColumn("copy", F.lit(0)).unionByName(copies)


def faults_per_row(df: DataFrame, faults: Sequence[Fault]) -> DataFrame:
    """How many rows carry 0, 1, 2, ... of the given faults."""
    carried = " + ".join(f"CAST({f.pick.rows()} AS INT)" for f in faults)
    return df.groupBy(F.expr(carried).alias("faults")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def answer_key(
    numbered: DataFrame, columns: Sequence[str], actions: Mapping[str, str]
) -> DataFrame:
    """One row per planted fault, with what is expected to be done about it.

    The actions are joined as a dimension of ``len(actions)`` literal rows,
    small enough to broadcast by construction.
    """
    dimension = numbered.sparkSession.createDataFrame(
        list(actions.items()), "error_type string, expected_action string"
    )
    return (
        numbered.withColumn("_entry", F.explode(PLANTED))
        .select("*", "_entry.*")
        .join(F.broadcast(dimension), "error_type", "left")
        .select(*columns)
    )

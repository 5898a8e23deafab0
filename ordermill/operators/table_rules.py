"""Rules on a whole table (V1, second kind): a key is unique, a key exists elsewhere.

Row rules look at one row; these look at keys. Rows that break one go to
the bad-row channel like any other, with a message, instead of failing the
run. Each rule first finds the violating keys by an aggregate with a partial
phase, over the rows that passed the row rules (a rejected row makes no
other row bad), and then joins on those keys only: few keys are broadcast
by their known size, many cross a shuffle join that AQE splits where one of
them holds a large share of the rows. A key with a NULL in it breaks none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.operators import validate as V
from ordermill.schemas import Schema
from ordermill.session import stored_table

# Error texts.
MSG_UNIQUE = "{names}: key is on {n} rows"
MSG_EXISTS = "{names}: no such {what}"


@dataclass(frozen=True)
class UniqueKey:
    """No two rows have the same values in ``columns``. ``keep`` names order
    columns: of the rows of a key, the one with the smallest values there
    stays; where several are smallest, or without ``keep``, none stays."""

    columns: tuple[str, ...]
    keep: tuple[str, ...] = ()


@dataclass(frozen=True)
class KeyExists:
    """The values in ``columns`` are those of some row of ``reference``
    (``of``: its columns in the same order)."""

    columns: tuple[str, ...]
    reference: DataFrame
    of: tuple[str, ...]
    what: str = "key"


def _keys(rule, typed: dict[str, Column]) -> dict[str, Column]:
    return {f"__k{i}": typed.get(c, F.col(c)) for i, c in enumerate(rule.columns)}


def _message(text: str, **parts) -> Column:
    pieces = text.split("{n}")
    out = [F.lit(pieces[0].format(**parts))]
    for rest in pieces[1:]:
        out += [F.col("__n").cast("string"), F.lit(rest.format(**parts))]
    return F.concat(*out)


def _whole(keys: dict[str, Column]) -> Column:
    every = F.lit(True)
    for c in keys:
        every = every & F.col(c).isNotNull()
    return every


def _violating(rows: DataFrame, rule, keys: dict[str, Column]) -> DataFrame:
    """(key columns, __message, and for ``keep`` __first: what the row that stays has)."""
    names = ", ".join(rule.columns)
    if isinstance(rule, KeyExists):
        there = rule.reference.select(*[F.col(c).alias(k) for c, k in zip(rule.of, keys)])
        missing = rows.select(*keys).where(_whole(keys)).distinct().join(there, list(keys), "left_anti")
        return missing.withColumn("__message", F.lit(MSG_EXISTS.format(names=names, what=rule.what)))
    counts = [F.count(F.lit(1)).alias("__n")]
    if rule.keep:
        counts.append(F.min(F.struct(*rule.keep)).alias("__first"))
    found = rows.where(_whole(keys)).groupBy(*keys).agg(*counts).where("__n > 1")
    found = found.withColumn("__message", _message(MSG_UNIQUE, names=names))
    if not rule.keep:
        return found.drop("__n")
    found = stored_table(found.drop("__n"), "repeated-keys")
    same = rows.join(found, list(keys)).where(F.struct(*rule.keep).eqNullSafe(F.col("__first")))
    alone = same.groupBy(*keys).count().where("count = 1").select(*keys, F.lit(True).alias("__alone"))
    return found.join(alone, list(keys), "left").withColumn("__first", F.when(F.col("__alone"), F.col("__first"))).drop("__alone")


def apply_rules(tagged: DataFrame, rules: list, schema: Schema | None = None, overrides: dict[str, Column] | None = None) -> DataFrame:
    """``tagged`` (with ``_error``, '' in good rows) with the messages of the
    rules that a good row breaks. Keys of schema columns are compared as
    typed values ('12' and '12.0' are one key)."""
    typed = V.typed_values(tagged, schema, overrides) if schema else {}
    for rule in rules:
        keys = _keys(rule, typed)
        rows = tagged.withColumns(keys)
        found = stored_table(_violating(rows.where(F.col(V.ERROR) == ""), rule, keys), "violating-keys")
        hit = F.col("__message").isNotNull() & (F.col(V.ERROR) == "")
        if "__first" in found.columns:
            hit = hit & ~(F.col("__first").isNotNull() & F.struct(*rule.keep).eqNullSafe(F.col("__first")))
        rows = rows.join(found, list(keys), "left").withColumn(V.ERROR, F.when(hit, F.col("__message")).otherwise(F.col(V.ERROR)))
        tagged = rows.select(*tagged.columns)
    return tagged

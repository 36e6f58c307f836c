"""Declared constraints as checks: rows (Tabla, Restriccion, Problemas), one per constraint.

Problemas counts rows, except for keys and unique columns, where it counts repeated values
(and for keys also rows without a value).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peoplemart.functions.numeric import how_many
from peoplemart.operators.duplicates import suspect_rows
from peoplemart.operators.references import lost, reference_profile
from peoplemart.sources.schemas import Reference, Table

Rules = list[tuple[str, Column]]  # label of a constraint and the condition that must hold


def breaking(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is false; one that is NULL passes, as in a SQL CHECK."""
    return df.filter(~condition)


def repeated(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values of the columns that occur more than once, with their number of rows."""
    return suspect_rows(df, columns).groupBy(*columns).agg(F.count("*").alias("Filas")).filter("Filas > 1")


def domain_rules(table: Table) -> Rules:
    return [(f"CHECK ({name} IN ({', '.join(values)}))", F.col(name).isin(*values))
            for name, values in table.domains.items()]


def _expression_rules(conditions: tuple[str, ...]) -> Rules:
    return [(f"CHECK ({condition})", F.expr(condition)) for condition in conditions]


def amount_rules(table: Table) -> Rules:
    return _expression_rules(table.amounts)


def order_rules(table: Table) -> Rules:
    return _expression_rules(table.orders)


def range_rules(table: Table) -> Rules:
    return _expression_rules(table.ranges)


def pairing_rules(table: Table) -> Rules:
    return _expression_rules(table.pairings)


def filled_rules(table: Table) -> Rules:
    return [(f"NOT NULL ({spec.name})", F.col(spec.name).isNotNull())
            for spec in table.columns if not spec.nullable]


def length_rules(table: Table) -> Rules:
    return [(f"LENGTH ({spec.name}) <= {spec.metadata['max_length']}",
             F.length(spec.name) <= spec.metadata["max_length"])
            for spec in table.columns if "max_length" in spec.metadata]


def row_rules(table: Table) -> Rules:
    """All rules that a row keeps or breaks by itself."""
    return [rule for rules_of in (filled_rules, length_rules, domain_rules, amount_rules, order_rules, range_rules, pairing_rules)
            for rule in rules_of(table)]


def _report_row(table: str, label: str, problems: Column) -> Column:
    return F.struct(F.lit(table).alias("Tabla"), F.lit(label).alias("Restriccion"),
                    problems.cast("bigint").alias("Problemas"))


def rule_report(df: DataFrame, table: str, rules: Rules) -> DataFrame:
    """All row rules of a table, counted in one scan."""
    counts = df.agg(*[how_many(~holds).alias(f"_{i}") for i, (_, holds) in enumerate(rules)])
    rows = [_report_row(table, label, F.col(f"_{i}")) for i, (label, _) in enumerate(rules)]
    return counts.select(F.inline(F.array(*rows)))


def key_report(df: DataFrame, table: str, key: str) -> DataFrame:
    rows = F.col("Filas")
    problems = F.sum(F.when(F.col(key).isNull(), rows).when(rows > 1, 1).otherwise(0))
    counts = suspect_rows(df, [key]).groupBy(key).agg(F.count("*").alias("Filas")).agg(F.coalesce(problems, F.lit(0)).alias("n"))
    return counts.select(F.inline(F.array(_report_row(table, f"PRIMARY KEY ({key})", F.col("n")))))


def unique_report(df: DataFrame, table: str, columns: tuple[str, ...]) -> DataFrame:
    counts = repeated(df, list(columns)).agg(F.count("*").alias("n"))
    label = f"UNIQUE ({', '.join(columns)})"
    return counts.select(F.inline(F.array(_report_row(table, label, F.col("n")))))


def reference_report(
    df: DataFrame, table: str, references: list[Reference], parents: Mapping[str, DataFrame]
) -> DataFrame:
    """All foreign keys of a table, counted in one scan of it."""
    counts = reference_profile(df, references, parents, {})
    rows = [_report_row(table, f"FOREIGN KEY ({r.column}) REFERENCES {r.parent}", F.col(lost(i)))
            for i, r in enumerate(references)]
    return counts.select(F.inline(F.array(*rows)))


def united(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def key_checks(tables: Mapping[str, DataFrame], specs: Mapping[str, Table]) -> DataFrame:
    return united([key_report(tables[name], name, spec.key) for name, spec in specs.items()])


def unique_checks(tables: Mapping[str, DataFrame], specs: Mapping[str, Table], composite: bool) -> DataFrame:
    """Unique constraints on one column, or on several if composite."""
    return united([
        unique_report(tables[name], name, columns)
        for name, spec in specs.items() for columns in spec.unique
        if (len(columns) > 1) == composite])


def reference_checks(
    tables: Mapping[str, DataFrame], specs: Mapping[str, Table], to_itself: bool = False
) -> DataFrame:
    """Foreign keys to other tables, or those of a table to itself."""
    found = {name: [r for r in spec.references if (r.parent == name) == to_itself] for name, spec in specs.items()}
    return united([reference_report(tables[name], name, references, tables)
                   for name, references in found.items() if references])


def rule_checks(tables: Mapping[str, DataFrame], specs: Mapping[str, Table], rules_of) -> DataFrame:
    """The rules that rules_of finds on each table, one scan per table that has any."""
    found = {name: rules_of(spec) for name, spec in specs.items()}
    return united([rule_report(tables[name], name, rules) for name, rules in found.items() if rules])

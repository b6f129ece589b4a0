"""Classes of lines, and the contract of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Classes of lines and their codes.
CLASSES = {
    "PARAGRAPH": 0, "PARAGRAPH_CONT": 1, "HEADING": 2, "HEADING_CONT": 3, "TOC": 4, "TABLE": 5, "HEADER": 6, "FOOTER": 7,
    "FOOT_NOTE": 8, "DEFINITION": 9, "BULLET_LIST": 10, "ENUM_LIST": 11, "GEN_LIST_CONT": 12, "BULLET_LIST_CONT": 13, "ENUM_LIST_CONT": 14,
}
# Classes that a model predicts, and base classes with their continuations, in the order of repair.
PREDICTED = (0, 1, 2, 3, 4)
PAIRS = ((2, 3), (0, 1), (11, 14), (10, 13), (12, 12))
NAMES = {v: k for k, v in CLASSES.items()}
CONTINUATIONS = (1, 3, 13, 14)
SOURCE_COLUMNS = ("LineNumbers", "text", "SourceClass", "SourceClassName", "PageNumber", "xml_idx")


def lookup(code: Column, table: dict) -> Column:
    """A small fixed table as an expression."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), code)


def class_name(code: Column) -> Column:
    return lookup(code.cast("int"), NAMES)


def require(df: DataFrame, columns) -> DataFrame:
    """df, if it has the columns; their absence is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def contract(df: DataFrame, columns=SOURCE_COLUMNS) -> DataFrame:
    """The columns of the contract, in order; others are dropped."""
    return require(df, columns).select(*columns)

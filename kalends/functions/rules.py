"""Classes from ordered rule tables: the first rule whose tests hold names the class."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, functions as F

_MODES = {
    "contains": lambda text, token: text.contains(token),
    "word": lambda text, token: F.concat(F.lit(" "), text, F.lit(" ")).contains(f" {token} "),
    "starts": lambda text, token: text.startswith(token),
    "ends": lambda text, token: text.endswith(token),
    "is": lambda text, token: text == token,
    "listed": lambda text, token: F.array_contains(F.split(text, r"\|"), token),
}


@dataclass(frozen=True)
class Test:
    """Whether one of the tokens occurs in a field, in the way that ``mode`` names."""

    field: str
    mode: str
    tokens: tuple[str, ...]

    def column(self, fields: Mapping[str, Column]) -> Column:
        return reduce(lambda a, b: a | b, [_MODES[self.mode](fields[self.field], token) for token in self.tokens])


@dataclass(frozen=True)
class Rule:
    """Names ``result`` where one test of ``some`` holds, each of ``every`` does and none of ``without``."""

    result: str
    some: tuple[Test, ...]
    every: tuple[Test, ...] = ()
    without: tuple[Test, ...] = ()

    def column(self, fields: Mapping[str, Column]) -> Column:
        found = reduce(lambda a, b: a | b, [t.column(fields) for t in self.some])
        found = reduce(lambda a, b: a & b, [t.column(fields) for t in self.every], found)
        return reduce(lambda a, b: a & ~b, [t.column(fields) for t in self.without], found)


def first_match(fields: Mapping[str, Column], rules: Sequence[Rule], default: str) -> Column:
    """Result of the first rule that holds; null fields count as empty text."""
    known = {name: F.coalesce(column, F.lit("")) for name, column in fields.items()}
    return F.coalesce(*(F.when(rule.column(known), F.lit(rule.result)) for rule in rules), F.lit(default))

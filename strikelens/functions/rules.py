"""Validation rules: a rule maps a column to a boolean column, true = valid.

A null never raises and never passes unless the rule says so: the result of
every rule is true or false, not null.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = Callable[[Column], Column]
RuleSet = Mapping[str, Sequence[Rule]]


def _definite(valid: Column) -> Column:
    return F.coalesce(valid, F.lit(False))


# What rules can be made of, by name. A rule of another kind is stored once its function is put here.
KINDS: dict[str, Callable[..., Column]] = {
    "not_null": lambda c: c.isNotNull(),
    "not_empty": lambda c: _definite(c != ""),
    "in_range": lambda c, low, high: F.coalesce(c.between(low, high), F.lit(True)),
    "known_in_range": lambda c, low, high: _definite(c.between(low, high)),
    "lacks": lambda c, text: _definite(~F.contains(c, F.lit(text))),
    "not_matching": lambda c, pattern: _definite(~c.rlike(rf"\A(?:{pattern})\z")),
}


@dataclass(frozen=True)
class StoredRule:
    """A rule that is data: the name of its kind and the arguments."""

    kind: str
    arguments: tuple = ()

    def __call__(self, column: Column) -> Column:
        return KINDS[self.kind](column, *self.arguments)


def not_null() -> Rule:
    return StoredRule("not_null")


def not_empty() -> Rule:
    return StoredRule("not_empty")


def in_range(low: int, high: int) -> Rule:
    """Inclusive at both ends. A null fails, unless a ``not_null`` beside it reports it, so that it counts once per field."""
    return StoredRule("in_range", (low, high))


def lacks(text: str) -> Rule:
    """Invalid when the value contains ``text`` anywhere."""
    return StoredRule("lacks", (text,))


def not_matching(pattern: str) -> Rule:
    """Invalid when the whole value matches ``pattern``."""
    return StoredRule("not_matching", (pattern,))


def to_specification(rules: RuleSet) -> list[dict]:
    """Fields with their rules as plain data, in order. A rule that is a bare function cannot be stored."""
    stored = []
    for field, of_field in rules.items():
        if not all(isinstance(rule, StoredRule) for rule in of_field):
            raise TypeError(f"a rule of {field} is a bare function; give it a name in KINDS and use StoredRule")
        stored.append({"field": field, "rules": [[rule.kind, *rule.arguments] for rule in of_field]})
    return stored


def from_specification(stored: list[dict]) -> RuleSet:
    return {entry["field"]: [StoredRule(kind, tuple(arguments)) for kind, *arguments in entry["rules"]] for entry in stored}


def checks(name: str, rules: Sequence[Rule]) -> list[Column]:
    """What each rule of a field says of a row. A range leaves null to a rule that reports it, and fails it alone."""
    if not_null() not in rules:
        rules = [
            StoredRule("known_in_range", rule.arguments) if isinstance(rule, StoredRule) and rule.kind == "in_range" else rule for rule in rules
        ]
    return [rule(F.col(name)) for rule in rules]


def all_valid(name: str, rules: Sequence[Rule]) -> Column:
    """Whether a field passes all its rules; a rule that answers null, as one of the user may, is not passed."""
    return _definite(reduce(and_, checks(name, rules)))


# The rules of each field of a raw record.
FIELD_RULES: RuleSet = {
    "year": [not_null(), in_range(1990, 2015)],
    "month": [not_null(), in_range(1, 12)],
    "day": [not_null(), in_range(1, 31)],
    "aircraft": [lacks("UNKNOWN")],
    "aircraft_mass": [not_null()],
    "engines": [not_null()],
    "airport_id": [not_matching(r"-?\d+(\.\d+)?"), lacks("UNKN")],
    "airport_name": [not_empty()],
    "state": [not_empty()],
    "faa_region": [not_empty()],
    "warning_issued": [not_null()],
    "flight_phase": [not_empty()],
    "species_id": [lacks("100000000000"), lacks("UNK")],
    "species_name": [not_empty(), lacks("UNKNOWN")],
    "species_quantity": [not_empty()],
    "fatalities": [not_null()],
    "injuries": [not_null()],
}

# What replaces the rules of the quantity text once it is parsed.
PARSED_QUANTITY_RULES: RuleSet = {
    "species_quantity_min": [not_null()],
    "species_quantity_max": [not_null()],
}

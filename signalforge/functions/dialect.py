"""SQL text for two engines from one builder: Spark runs the query, and a second engine can check it.

Operators write their plans as SQL over the builder's functions. Everything stays declarative, so Catalyst sees plain
built-in expressions: patterns are literals (compiled once a task), lists are one alternation each.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations", "labels", "benchmark")


def alternation(words: Iterable[str]) -> str:
    """A pattern for any of some literal words, the longest first."""
    escape = lambda w: "".join("\\" + c if c in r".+*?()[]{}|^$\\" else c for c in w)
    return "(?:" + "|".join(escape(w) for w in sorted(words, key=lambda w: (-len(w), w))) + ")"


class Dialect:
    """Spark SQL; the few differences of the other engine are in Checker."""

    name = "spark"

    def lit(self, s: str) -> str:
        return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def rx(self, col: str, pattern: str) -> str:
        return f"({col} RLIKE {self.lit(pattern)})"

    def any_rx(self, col: str, patterns: Sequence[str], flags: str = "") -> str:
        return self.rx(col, flags + "(?:" + "|".join(patterns) + ")")

    def any_of(self, col: str, words: Sequence[str]) -> str:
        return self.rx(col, alternation(words))

    def extract(self, col: str, pattern: str, group: int = 0) -> str:
        return f"regexp_extract({col}, {self.lit(pattern)}, {group})"

    def replace(self, col: str, pattern: str, to: str = "") -> str:
        return f"regexp_replace({col}, {self.lit(pattern)}, {self.lit(to)})"

    def count_rx(self, col: str, pattern: str) -> str:
        return f"CAST(regexp_count({col}, {self.lit(pattern)}) AS BIGINT)"

    def all_rx(self, col: str, pattern: str, group: int = 0) -> str:
        return f"regexp_extract_all({col}, {self.lit(pattern)}, {group})"

    def has(self, col: str, word: str) -> str:
        return f"contains({col}, {self.lit(word)})"

    def isin(self, col: str, words: Sequence[str]) -> str:
        return f"({col} IN ({', '.join(self.lit(w) for w in words)}))"

    def case(self, pairs: Sequence[tuple[str, str]], otherwise: str = "NULL") -> str:
        return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {otherwise} END"

    def first_word(self, col: str, words: Sequence[str], otherwise: str = "''") -> str:
        """The first of the words, in list order, that col contains."""
        return self.case([(self.has(col, w), self.lit(w)) for w in words], otherwise)

    def array(self, items: Sequence[str]) -> str:
        return f"array({', '.join(items)})"

    def filter(self, array: str, var: str, test: str) -> str:
        return f"filter({array}, {var} -> {test})"

    def transform(self, array: str, var: str, value: str) -> str:
        return f"transform({array}, {var} -> {value})"

    def size(self, array: str) -> str:
        return f"CAST(size({array}) AS BIGINT)"

    def get(self, array: str, i: int) -> str:
        return f"get({array}, {i})"

    def join(self, array: str, sep: str) -> str:
        return f"array_join({array}, {self.lit(sep)})"

    def distinct(self, array: str) -> str:
        return f"array_distinct({array})"

    def chain(self, first: str, second: str) -> str:
        """The elements of one array, then those of another."""
        return f"concat({first}, {second})"

    def sort(self, array: str) -> str:
        return f"array_sort({array})"

    def struct(self, **fields: str) -> str:
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"

    def indexed(self, array: str, var: str, index: str, value: str) -> str:
        """Like transform, with the element's number from 0."""
        return f"transform({array}, ({var}, {index}) -> {value})"

    def head(self, array: str, n: int | str) -> str:
        return f"slice({array}, 1, {n})"

    def place_in(self, array: str, value: str) -> str:
        """The number of a value in an array, from 1; 0 if it is not there."""
        return f"CAST(array_position({array}, {value}) AS BIGINT)"

    def places(self, col: str, word: str) -> str:
        """Where the literal `word` (an expression, not empty) starts in col, from 0, without overlaps."""
        x = f"split({col}, concat('\\\\Q', {word}, '\\\\E'), -1)"
        before = f"aggregate(slice({x}, 1, i_ + 1), 0, (acc_, u_) -> acc_ + length(u_))"
        return f"transform(slice({x}, 1, size({x}) - 1), (s_, i_) -> CAST({before} + i_ * length({word}) AS BIGINT))"

    def split(self, col: str, pattern: str) -> str:
        return f"split({col}, {self.lit(pattern)})"

    def without(self, *columns: str) -> str:
        """All columns but these."""
        return f"* EXCEPT ({', '.join(columns)})"

    def explode(self, table: str, array: str, columns: str, alias: str) -> str:
        return f"SELECT {columns}, explode({array}) AS {alias} FROM {table}"

    def arg_min(self, value: str, *by: str) -> str:
        return f"min_by({value}, struct({', '.join(by)}))"

    def arg_max(self, value: str, *by: str) -> str:
        return f"max_by({value}, struct({', '.join(by)}))"

    def values(self, rows: Sequence[Sequence], columns: str) -> str:
        cell = lambda v: "NULL" if v is None else self.lit(v) if isinstance(v, str) else str(v)
        return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) AS t({columns})"

    def json(self, col: str, key: str) -> str:
        return f"get_json_object({col}, {self.lit('$.' + key)})"

    def utc(self, ms: str) -> str:
        return f"date_format(timestamp_millis({ms}), \"yyyy-MM-dd'T'HH:mm:ssxxx\")"

    def title(self, col: str) -> str:
        return f"initcap({col})"

    def rtrim(self, col: str, chars: str) -> str:
        return f"rtrim({self.lit(chars)}, {col})"


class Checker(Dialect):
    """The second engine's spelling."""

    name = "checker"

    def lit(self, s: str) -> str:
        return "'" + s.replace("'", "''") + "'" if "\n" not in s else "'" + s.replace("'", "''") + "'"

    def rx(self, col: str, pattern: str) -> str:
        return f"regexp_matches({col}, {self.lit(pattern)})"

    def replace(self, col: str, pattern: str, to: str = "") -> str:
        return f"regexp_replace({col}, {self.lit(pattern)}, {self.lit(to.replace('$1', chr(92) + '1'))}, 'g')"

    def count_rx(self, col: str, pattern: str) -> str:
        return f"CAST(len(regexp_extract_all({col}, {self.lit(pattern)})) AS BIGINT)"

    def array(self, items: Sequence[str]) -> str:
        return f"[{', '.join(items)}]"

    def filter(self, array: str, var: str, test: str) -> str:
        return f"list_filter({array}, lambda {var}: {test})"

    def transform(self, array: str, var: str, value: str) -> str:
        return f"list_transform({array}, lambda {var}: {value})"

    def size(self, array: str) -> str:
        return f"CAST(len({array}) AS BIGINT)"

    def get(self, array: str, i: int) -> str:
        return f"({array})[{i + 1}]"

    def join(self, array: str, sep: str) -> str:
        return f"array_to_string({array}, {self.lit(sep)})"

    def distinct(self, array: str) -> str:
        return f"list_distinct({array})"

    def chain(self, first: str, second: str) -> str:
        return f"list_concat({first}, {second})"

    def sort(self, array: str) -> str:
        return f"list_sort({array})"

    def struct(self, **fields: str) -> str:
        return "struct_pack(" + ", ".join(f"{k} := {v}" for k, v in fields.items()) + ")"

    def indexed(self, array: str, var: str, index: str, value: str) -> str:
        return f"list_transform({array}, lambda {var}, {index}_: {re.sub(rf'{chr(92)}b{index}{chr(92)}b', f'({index}_ - 1)', value)})"

    def head(self, array: str, n: int | str) -> str:
        return f"({array})[1:{n}]"

    def place_in(self, array: str, value: str) -> str:
        return f"CAST(coalesce(list_position({array}, {value}), 0) AS BIGINT)"

    def places(self, col: str, word: str) -> str:
        x = f"string_split({col}, {word})"
        before = f"list_sum(list_transform({x}[1:i_], lambda u_: length(u_)))"
        return f"list_transform({x}[1:len({x}) - 1], lambda s_, i_: CAST({before} + (i_ - 1) * length({word}) AS BIGINT))"

    def split(self, col: str, pattern: str) -> str:
        return f"regexp_split_to_array({col}, {self.lit(pattern)})"

    def without(self, *columns: str) -> str:
        return f"* EXCLUDE ({', '.join(columns)})"

    def explode(self, table: str, array: str, columns: str, alias: str) -> str:
        return f"SELECT {columns}, unnest({array}) AS {alias} FROM {table}"

    def arg_min(self, value: str, *by: str) -> str:
        return f"arg_min({value}, row({', '.join(by)}))"

    def arg_max(self, value: str, *by: str) -> str:
        return f"arg_max({value}, row({', '.join(by)}))"

    def json(self, col: str, key: str) -> str:
        return f"json_extract_string({col}, {self.lit('$.' + key)})"

    def utc(self, ms: str) -> str:
        return f"strftime(make_timestamp(CAST({ms} AS BIGINT) * 1000), '%Y-%m-%dT%H:%M:%S+00:00')"

    def title(self, col: str) -> str:
        return f"array_to_string(list_transform(string_split({col}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"

    def rtrim(self, col: str, chars: str) -> str:
        return f"rtrim({col}, {self.lit(chars)})"

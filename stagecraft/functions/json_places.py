"""Where a JSON line goes wrong: a pattern walks its members from the left.

The members of a line's object are matched one after the other, each starting
where the last one ended, so a place is the sum of the lengths before it.
Patterns are possessive: a line takes one pass and no stack, however long a
string in it is. Values that nest deeper than ``DEPTH`` count as one place, their start.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

#: Nesting of arrays and objects in a value that is followed.
DEPTH = 3

_STRING = r'"(?:[^"\\\x00-\x1f]++|\\(?:["\\/bfnrt]|u[0-9A-Fa-f]{4}))*+"'
_PLAIN = rf"(?:{_STRING}|-?+(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?+[0-9]++)?+|true|false|null)"


def _value(depth: int) -> str:
    if not depth:
        return _PLAIN
    inner = _value(depth - 1)
    item, pair = rf"\s*+{inner}\s*+", rf"\s*+{_STRING}\s*+:\s*+{inner}\s*+"
    return rf"(?:{_PLAIN}|\[(?:{item}(?:,{item})*+|\s*+)\]|\{{(?:{pair}(?:,{pair})*+|\s*+)\}})"


_MEMBER = rf"\s*+{_STRING}\s*+:\s*+{_value(DEPTH)}\s*+"
#: The members of the line's object in order, each with the brace or comma before it.
_MEMBERS = rf"(?:^\s*+\{{|\G(?<!^),){_MEMBER}"
#: What follows the brace, or the last whole member, and can still be right: a comma, a key, its colon.
_BEGUN = rf"\s*+(?:({_STRING})\s*+(?::\s*+)?+)?+"
_FIRST, _NEXT = rf"^\s*+(?:\{{{_BEGUN})?+", rf"^(?:,{_BEGUN})?+"
_KEY = rf"^[\s{{,]*+({_STRING})"


def _plain_key(quoted: Column) -> Column:
    """A quoted key as text (escapes stay as they stand)."""
    return F.when(F.length(quoted) >= 2, F.substring(quoted, F.lit(2), F.length(quoted) - 2))


def json_error(line: Column, typed: Column, texts: Column, schema: T.StructType) -> tuple[Column, Column, Column]:
    """(message, column, 1-based character position) of a bad JSON line.

    ``typed``: the line's values by the schema; ``texts``: the same as strings.
    A value that its type does not take is the error if the line is JSON;
    otherwise the place where it stops being JSON, in the member begun last.
    """
    fields = schema.fields
    wrong = F.coalesce(*[F.when(texts[f.name].isNotNull() & typed[f.name].isNull(), F.lit(i)) for i, f in enumerate(fields)],
                       F.lit(None).cast("int"))
    members = F.regexp_extract_all(line, F.lit(_MEMBERS), F.lit(0))
    names = F.array(*[F.lit(f.name) for f in fields])
    types = F.array(*[F.lit(f.dataType.simpleString()) for f in fields])

    def of(found: Column, key_index: Column) -> Column:
        name = F.element_at(names, (key_index + 1).cast("int"))
        keys = F.transform(found, lambda m: F.lower(_plain_key(F.regexp_extract(m, _KEY, 1))))
        at = F.array_position(keys, F.lower(name)).cast("int")
        whole = F.aggregate(F.slice(found, 1, F.greatest(at - 1, F.lit(0))), F.lit(0), lambda n, m: n + F.length(m))
        before_value = F.length(F.regexp_extract(F.element_at(found, F.when(at > 0, at)), rf"^[\s{{,]*+{_STRING}\s*+:\s*+", 0))
        done = F.aggregate(found, F.lit(0), lambda n, m: n + F.length(m))
        rest = F.substring(line, done + 1, F.length(line))
        def tail(group: int) -> Column:
            return F.when(F.size(found) == 0, F.regexp_extract(rest, _FIRST, group)).otherwise(F.regexp_extract(rest, _NEXT, group))

        opened = tail(0)
        begun = _plain_key(F.coalesce(F.nullif(tail(1), F.lit("")),
                                      F.regexp_extract(F.element_at(found, F.when(F.size(found) > 0, -1)), _KEY, 1)))
        return F.when(key_index.isNotNull() & (at > 0), F.struct(
            F.concat(F.lit("Value '"), F.element_at(F.array(*[texts[f.name] for f in fields]), (key_index + 1).cast("int")), F.lit("' is not a valid "),
                     F.element_at(types, (key_index + 1).cast("int")), F.lit(" for column "), F.upper(name)).alias("message"),
            F.upper(name).alias("col"), (whole + before_value + 1).cast("long").alias("pos"))).otherwise(F.struct(
                F.lit("Invalid JSON record").alias("message"), F.upper(begun).alias("col"), (done + F.length(opened) + 1).cast("long").alias("pos")))

    # Evaluated once a line: the members, then what is told about them.
    told = F.element_at(F.transform(F.array(F.struct(members.alias("m"), wrong.alias("w"))), lambda x: of(x["m"], x["w"])), 1)
    return told["message"], told["col"], told["pos"]

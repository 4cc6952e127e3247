"""JSON Schema as column expressions: a schema is compiled once, records are checked inside the JVM.

A record is parsed to a variant.  Every schema node becomes an expression over
the variant at its place that gives an array of messages; the arrays of a record
are joined in the order of the schema.  Local references are resolved while
compiling, so a schema that refers to itself is refused.

Known keywords are type, const, enum, pattern, minLength, maxLength, minItems,
items, required, properties, additionalProperties (false only; names that begin
with an underscore are always allowed) and $ref, beside which other keywords do
not count.  Other keywords have no effect.  Where the type is wrong nothing
below is looked at.  Numbers are compared by value, so 1.0 is an integer; a
repeated key makes a record invalid, as does what is not JSON.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_JSON = "$: cannot be read as JSON"
NONE = "cast(array() as array<string>)"
Messages = Callable[[str, str], str]  # SQL of a variant and of its place to SQL of array<string>


def quoted(text: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def kind(v: str) -> str:
    """The narrowest schema type of a variant."""
    shape = f"schema_of_variant({v})"
    return f"""case when {shape} like 'OBJECT%' then 'object' when {shape} like 'ARRAY%' then 'array' when {shape} = 'STRING' then 'string' when {shape} = 'BOOLEAN' then 'boolean'
        when {shape} = 'VOID' then 'null' when try_variant_get({v}, '$', 'double') % 1 = 0 then 'integer' else 'number' end"""


def equals(v: str, wanted: object) -> str:
    """Whether a variant is the JSON value ``wanted``; numbers by value."""
    if isinstance(wanted, (int, float)) and not isinstance(wanted, bool):
        return f"({kind(v)} in ('integer', 'number') and try_variant_get({v}, '$', 'double') = {float(wanted)!r}D)"
    return f"(to_json({v}) = to_json(parse_json({quoted(json.dumps(wanted))})))"


def complaint(holds: str, place: str, text: str) -> str:
    """An array with one message where ``holds`` is not true."""
    return f"if(coalesce({holds}, false), {NONE}, array(concat({place}, {quoted(': ' + text)})))"


def text_rules(rule: dict) -> list[Messages]:
    said = lambda v: f"try_variant_get({v}, '$', 'string')"
    out: list[Messages] = []
    if "pattern" in rule:
        out.append(lambda v, at: complaint(f"{said(v)} rlike {quoted(rule['pattern'])}", at, f"does not fit {rule['pattern']}"))
    if "minLength" in rule:
        out.append(lambda v, at: complaint(f"length({said(v)}) >= {rule['minLength']}", at, f"needs {rule['minLength']} characters or more"))
    if "maxLength" in rule:
        out.append(lambda v, at: complaint(f"length({said(v)}) <= {rule['maxLength']}", at, f"may have {rule['maxLength']} characters at most"))
    return out


def list_rules(rule: dict, compile_: Callable[[dict], Messages], depth: int) -> list[Messages]:
    items = lambda v: f"try_variant_get({v}, '$', 'array<variant>')"
    out: list[Messages] = []
    if "minItems" in rule:
        out.append(lambda v, at: complaint(f"size({items(v)}) >= {rule['minItems']}", at, f"needs {rule['minItems']} items or more"))
    if "items" in rule:
        each, x, i = compile_(rule["items"]), f"x{depth}", f"i{depth}"
        out.append(lambda v, at: f"flatten(transform({items(v)}, ({x}, {i}) -> {each(x, f"concat({at}, '[', {i}, ']')")}))")
    return out


def record_rules(rule: dict, compile_: Callable[[dict], Messages], depth: int) -> list[Messages]:
    names = lambda v: f"map_keys(try_variant_get({v}, '$', 'map<string,variant>'))"
    told = lambda at, which, what: f"transform({which}, k{depth} -> concat({at}, ': {what} ', k{depth}))"
    known = rule.get("properties", {})
    listed = lambda items: f"array({', '.join(map(quoted, items))})" if items else NONE
    out: list[Messages] = []
    if rule.get("required"):
        out.append(lambda v, at: told(at, f"array_except({listed(rule['required'])}, {names(v)})", "lacks"))
    if rule.get("additionalProperties") is False:
        out.append(lambda v, at: told(at, f"filter(array_except({names(v)}, {listed(known)}), n{depth} -> not startswith(n{depth}, '_'))", "does not know"))

    def inside(name: str) -> Messages:
        below, path = compile_(known[name]), quoted("$[" + json.dumps(name, ensure_ascii=False) + "]")

        def check(v: str, at: str) -> str:
            own = f"try_variant_get({v}, {path}, 'variant')"
            return f"if({own} is null, {NONE}, {below(own, f'concat({at}, {quoted("." + name)})')})"

        return check

    return out + [inside(name) for name in known]


def compiled(rule: dict, root: dict, above: tuple[str, ...] = (), depth: int = 0) -> Messages:
    """The messages of one schema node."""
    if "$ref" in rule:
        name = rule["$ref"]
        if name in above or not name.startswith("#"):
            raise ValueError(f"cannot compile the reference {name!r}")
        node = root
        for step in filter(None, name[1:].split("/")):
            node = node[step]
        return compiled(node, root, (*above, name), depth)
    below = lambda r: compiled(r, root, above, depth + 1)
    typed = [*(("string", m) for m in text_rules(rule)), *(("array", m) for m in list_rules(rule, below, depth)), *(("object", m) for m in record_rules(rule, below, depth))]
    wanted = [rule["type"]] if isinstance(rule.get("type"), str) else rule.get("type")

    def deeper(v: str, at: str) -> str:
        parts = []
        if "enum" in rule:
            parts.append(complaint(" or ".join(equals(v, x) for x in rule["enum"]), at, f"must be one of {json.dumps(rule['enum'])}"))
        for name in ("string", "array", "object"):
            own = [m(v, at) for k, m in typed if k == name]
            if own:
                parts.append(f"if({kind(v)} = '{name}', concat({', '.join(own)}), {NONE})")
        return f"concat({', '.join(parts)})" if parts else NONE

    def check(v: str, at: str) -> str:
        out = deeper(v, at)
        if wanted:
            fits = ", ".join(quoted(x) for x in ([*wanted, "integer"] if "number" in wanted else wanted))
            out = f"if({kind(v)} in ({fits}), {out}, array(concat({at}, ': is ', {kind(v)}, {quoted(', must be ' + ' or '.join(wanted))})))"
        if "const" in rule:
            out = f"concat({complaint(equals(v, rule['const']), at, f'must be {json.dumps(rule["const"])}')}, {out})"
        return out

    return check


def schema_problems(raw: str, schema: dict, root: dict | None = None) -> Column:
    """array<string> of messages for each JSON text in the column named ``raw``; a null text is like one that is not JSON."""
    own = f"try_parse_json(`{raw}`)"
    return F.expr(f"if({own} is null, array({quoted(NOT_JSON)}), {compiled(schema, root or schema)(own, quoted('$'))})")


def problems_of(spark, values: Iterable[str], schema: dict) -> list[list[str]]:
    """Messages of a few JSON texts, for tests and the command line."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, raw string")
    return [r["m"] for r in rows.select("i", schema_problems("raw", schema).alias("m")).orderBy("i").collect()]

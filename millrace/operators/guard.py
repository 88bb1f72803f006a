"""Expressions that fail as data: each becomes its value and, where it fails on a row, the cause.

Spark parses the expression; the nodes of its tree that can fail on a row's values are replaced, by their place in the
text, with forms that give null, and what failed is told by a second expression over the same operands. A null that is
right has no cause. Operands that the expression would not evaluate (other branches, the right side of a settled ``and``,
later arguments of ``coalesce``) cause nothing. Inside lambda functions, windows and subqueries the text stays as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPAQUE = {"LambdaFunction", "WindowExpression", "ScalarSubquery", "Exists", "ListQuery", "InSubquery"}
CHECKED = {"Add": "try_add", "Subtract": "try_subtract", "Multiply": "try_multiply", "Divide": "try_divide", "Remainder": "try_mod"}
PARSERS = {"to_date": "try_to_date", "to_timestamp": "try_to_timestamp", "to_number": "try_to_number", "to_binary": "try_to_binary",
           "parse_json": "try_parse_json", "url_decode": "try_url_decode", "make_timestamp": "try_make_timestamp"}
CASTS = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp"}


@dataclass(frozen=True)
class Guarded:
    value: str  # SQL that never fails where its operands don't
    cause: str | None  # SQL: the cause as text, or null; None where nothing can fail


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def first_of(*causes: str | None) -> str | None:
    known = [c for c in causes if c]
    return known[0] if len(known) < 2 and known else f"coalesce({', '.join(known)})" if known else None


def guard(df: DataFrame, text: str) -> Guarded:
    """The expression ``text`` over the columns of df as value and cause."""
    tree = df.sparkSession._jsparkSession.sessionState().sqlParser().parseExpression(text)
    return _Walk(df, text).walk(tree, None)[0]


class _Walk:
    def __init__(self, df: DataFrame, text: str):
        self.df, self.text = df, text

    def kind(self, sql: str) -> T.DataType:
        return self.df.select(F.expr(sql)).schema[0].dataType

    def span(self, node: JavaObject) -> tuple[int, int] | None:
        """First and last character that a node was written with."""
        begin, end = node.origin().startIndex(), node.origin().stopIndex()
        return (begin.get(), end.get()) if begin.isDefined() and end.isDefined() else None

    def walk(self, node: JavaObject, above: tuple[int, int] | None) -> tuple[Guarded, tuple[int, int] | None]:
        """A node's guarded form and its place; a node that the parser made up has its parent's place, or none."""
        name, place = node.getClass().getSimpleName(), self.span(node)
        if name in OPAQUE:
            return Guarded(self.text[place[0]:place[1] + 1], None), place
        children = [node.children().apply(i) for i in range(node.children().length())]
        below = [self.walk(c, place) for c in children]
        forms = [form for form, _ in below]
        made_up = place is None or place == above
        if made_up and name == "EqualTo":  # of ``case x when y``
            source = f"(({forms[0].value}) = ({forms[1].value}))"
        else:
            names = {p for c, (_, p) in zip(children, below) if c.getClass().getSimpleName() == "Alias"}
            source, place = self.rewritten(place, below, names)
        own, own_cause = self.failing(node, name, [f.value for f in forms], source, place)
        return Guarded(own, first_of(self.reached(node, name, forms), own_cause)), place

    def rewritten(self, place: tuple[int, int], below: list, bare: set) -> tuple[str, tuple[int, int]]:
        """The node's own text with its operands' in their guarded form, and the place of both together. Operands that
        carry a name (``bare``) may not stand in brackets."""
        inside = {p: form.value for form, p in below if p is not None and p != place}
        begin, end = min([place[0], *(p[0] for p in inside)]), max([place[1], *(p[1] for p in inside)])
        out, at = "", begin
        for (first, last), value in sorted(inside.items()):
            if first < at:
                continue  # inside an operand that was written before
            plain = (first, last) in bare or value == self.text[first:last + 1]
            out += self.text[at:first] + (value if plain else f"({value})")
            at = last + 1
        return out + self.text[at:end + 1], (begin, end)

    def reached(self, node: JavaObject, name: str, forms: list[Guarded]) -> str | None:
        """The first cause among the operands that are evaluated."""
        causes, values = [f.cause for f in forms], [f.value for f in forms]
        if not any(causes):
            return None
        called = node.prettyName().lower()
        null = "cast(null as string)"
        if name == "CaseWhen":
            arms = []
            for i in range(0, len(forms) - 1, 2):
                if causes[i]:
                    arms.append(f"when {causes[i]} is not null then {causes[i]}")
                arms.append(f"when {values[i]} then {causes[i + 1] or null}")
            return f"(case {' '.join(arms)} else {(causes[-1] if len(forms) % 2 else None) or null} end)"
        if name in ("And", "Or") and causes[1]:
            goes_on = f"coalesce({values[0]}, {'true' if name == 'And' else 'false'})"
            return first_of(causes[0], f"if({goes_on if name == 'And' else f'not {goes_on}'}, {causes[1]}, {null})")
        if called in ("if", "nvl2") and len(forms) == 3:
            test = values[0] if called == "if" else f"({values[0]}) is not null"
            return first_of(causes[0], f"if({test}, {causes[1] or null}, {causes[2] or null})")
        if called in ("coalesce", "nvl", "ifnull"):
            found = None
            for cause, value in reversed(list(zip(causes, values))):
                later = f"if(({value}) is null, {found}, {null})" if found else None
                found = first_of(cause, later)
            return found
        return first_of(*causes)

    def failing(self, node: JavaObject, name: str, values: list[str], source: str, place: tuple[int, int] | None) -> tuple[str, str | None]:
        """The form of the node itself that gives null where it fails, and the cause it then has."""
        said = " ".join(self.text[place[0]:place[1] + 1].split()) if place else source
        if name == "Cast":
            if node.prettyName() == "try_cast":
                return source, None
            return self.cast(values[0], node.dataType().sql())
        if name in CHECKED:
            left, right = values
            new = f"{CHECKED[name]}({left}, {right})"
            lost = f"{new} is null and ({left}) is not null and ({right}) is not null"
            if name in ("Divide", "Remainder"):
                return new, f"case when {lost} then if(({right}) = 0, {quoted('DIVIDE_BY_ZERO: ' + said)}, {quoted('ARITHMETIC_OVERFLOW: ' + said)}) end"
            return new, f"case when {lost} then {quoted('ARITHMETIC_OVERFLOW: ' + said)} end"
        if name == "IntegralDivide":
            left, right = values
            return (f"(case when ({right}) <> 0 then ({left}) div ({right}) end)",
                    f"case when ({right}) = 0 and ({left}) is not null then {quoted('DIVIDE_BY_ZERO: ' + said)} end")
        if name == "UnresolvedExtractValue" and isinstance(self.kind(values[0]), T.ArrayType):
            array, at = values
            return (f"get({array}, {at})",
                    f"case when ({at}) < 0 or ({at}) >= size({array}) then concat('INVALID_ARRAY_INDEX: ', {at}, ' of ', size({array})) end")
        if name == "UnresolvedFunction":
            return self.function(node.prettyName().lower(), values, source, said)
        return source, None

    def cast(self, value: str, kind: str) -> tuple[str, str]:
        new = f"try_cast(({value}) as {kind})"
        return new, (f"case when ({value}) is not null and {new} is null then "
                     f"concat('CAST_INVALID_INPUT: ', cast(({value}) as string), ' as {kind}') end")

    def function(self, called: str, values: list[str], source: str, said: str) -> tuple[str, str | None]:
        if called in CASTS and len(values) == 1:
            return self.cast(values[0], called.upper())
        if called in PARSERS:
            new = f"{PARSERS[called]}({', '.join(values)})"
            given = " and ".join(f"({v}) is not null" for v in values)
            return new, f"case when {new} is null and {given} then concat({quoted(f'CANNOT_PARSE: {called} of ')}, cast({values[0]} as string)) end"
        if called == "mod" and len(values) == 2:
            return (f"try_mod({values[0]}, {values[1]})",
                    f"case when ({values[1]}) = 0 and ({values[0]}) is not null then {quoted('DIVIDE_BY_ZERO: ' + said)} end")
        if called == "element_at" and isinstance(self.kind(values[0]), T.ArrayType):
            array, at = values
            return (f"if(({at}) = 0, null, try_element_at({array}, {at}))",
                    f"case when ({at}) = 0 or abs({at}) > size({array}) then concat('INVALID_ARRAY_INDEX: ', {at}, ' of ', size({array})) end")
        if called == "raise_error":
            return "cast(null as void)", f"coalesce(cast(({values[0]}) as string), 'USER_RAISED_EXCEPTION')"
        if called == "assert_true":
            told = f"cast(({values[1]}) as string)" if len(values) > 1 else quoted(f"{said} does not hold")
            return "cast(null as void)", f"case when not coalesce({values[0]}, false) then coalesce({told}, 'USER_RAISED_EXCEPTION') end"
        return source, None


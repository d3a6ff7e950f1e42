"""Chat templates as column expressions: a template text is translated once, and rendering is part of the plan.

The language is the part of the usual template language that chat templates are written in: text, ``{{ … }}``, ``{% for m in … %}``,
``{% if … %}`` with ``elif`` and ``else``, ``{% set … %}``, comments, and ``-`` for white space control; like tokenizers do, a line
break after a block and blanks before one are dropped. Expressions have ``messages`` and its parts by index, slice, key or
attribute, ``loop.index``, ``index0``, ``first``, ``last`` and ``length``, literals, ``+ ~ % == != < > <= >= in not and or``,
``… if … else …``, the tests ``defined``, ``none`` and ``string``, the filters ``trim``, ``length``, ``upper``, ``lower`` and ``safe``,
``.strip()``, ``.startswith()``, ``.endswith()``, ``.split()``, and ``raise_exception``. Anything else is refused when
the template is translated. Names that are not given are undefined, which counts as false.

A chat is null where the template raises, and where a text that is missing is written or joined.
"""

from __future__ import annotations

import ast
import io
import re
import tokenize
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptorium.functions.text import once, strip

_TAG = re.compile(r"(\{%[-+]?.*?[-+]?%\}|\{\{-?.*?-?\}\}|\{#-?.*?-?#\})", re.DOTALL)
_FIELDS = ("role", "content")


class TemplateError(ValueError):
    """A template uses what is not supported, or is not well formed."""


@dataclass(frozen=True)
class Typed:
    """A value that a row decides: its kind (text, texts, flag, number, message or messages) and its column."""

    kind: str
    column: Column


class _Undefined:
    pass


UNDEFINED = _Undefined()


# --- template text to a tree ----------------------------------------------------------------------------


def _pieces(template: str) -> Iterator[tuple[str, str]]:
    """(kind, body) of text, expressions and statements, white space dropped as the tags say."""
    parts = _TAG.split(template)
    for i in range(1, len(parts), 2):
        tag, block = parts[i], parts[i][1] != "{"
        if tag[2] == "-":
            parts[i - 1] = parts[i - 1].rstrip()
        elif block and tag[2] != "+":
            # blanks are all there is on the line so far
            line = parts[i - 1].rpartition("\n")
            if not line[2].strip(" \t") and (line[1] or i == 1):
                parts[i - 1] = line[0] + line[1]
        if tag[-3] == "-":
            parts[i + 1] = parts[i + 1].lstrip()
        elif block and parts[i + 1].startswith("\n"):
            parts[i + 1] = parts[i + 1][1:]
    for i, part in enumerate(parts):
        if i % 2 == 0:
            if part:
                yield "text", part
        elif part[1] != "#":
            yield ("write" if part[1] == "{" else "do"), part[2:-2].strip("-+").strip()


def _expression(source: str) -> ast.expr:
    """An expression as Python reads it, with filters as an operator that binds tighter than a sum."""
    signs = {"|": "@", "~": "+"}
    try:
        tokens = tokenize.generate_tokens(io.StringIO(source.replace("\n", " ")).readline)
        read = [(t.type, signs.get(t.string, t.string) if t.type == tokenize.OP else t.string) for t in tokens]
        return ast.parse(tokenize.untokenize(read).strip(), mode="eval").body
    except (SyntaxError, tokenize.TokenError) as error:
        raise TemplateError(f"cannot read {source!r}") from error


@dataclass
class For:
    name: str
    over: ast.expr
    body: list


@dataclass
class If:
    branches: list[tuple[ast.expr | None, list]]


@dataclass
class Set:
    name: str
    value: ast.expr


def _tree(pieces: Iterator[tuple[str, str]], until: tuple[str, ...] = ()) -> tuple[list, str]:
    """Nodes up to a statement that begins with one of ``until``, and that statement."""
    nodes: list = []
    for kind, body in pieces:
        word, _, rest = body.partition(" ")
        if kind == "text":
            nodes.append(body)
        elif kind == "write":
            nodes.append(_expression(body))
        elif word in until:
            return nodes, body
        elif word == "for" and (head := re.fullmatch(r"(\w+) in (.+)", rest.strip(), re.DOTALL)):
            nodes.append(For(head[1], _expression(head[2]), _tree(pieces, ("endfor",))[0]))
        elif word == "if":
            branches, condition = [], rest
            while condition is not None:
                inner, closing = _tree(pieces, ("elif", "else", "endif"))
                branches.append((_expression(condition) if condition else None, inner))
                word, _, rest = closing.partition(" ")
                condition = {"elif": rest, "else": ""}.get(word)
            nodes.append(If(branches))
        elif word == "set" and (head := re.fullmatch(r"(\w+)\s*=(.+)", rest, re.DOTALL)):
            nodes.append(Set(head[1], _expression(head[2].strip())))
        else:
            raise TemplateError(f"not supported: {body!r}")
    if until:
        raise TemplateError(f"{until[-1]} is missing")
    return nodes, ""


# --- values ---------------------------------------------------------------------------------------------


def _column(value: Any) -> Column:
    return value.column if isinstance(value, Typed) else F.lit(value)


def _kind(value: Any) -> str:
    if isinstance(value, Typed):
        return value.kind
    kinds = {bool: "flag", int: "number", str: "text", type(None): "none", _Undefined: "undefined"}
    return kinds.get(type(value), "list")


def _truth(value: Any) -> Any:
    """A value as a condition: a bool, or a column that is never null."""
    if not isinstance(value, Typed):
        return value is not UNDEFINED and bool(value)
    sized = {"texts": F.size, "messages": F.size, "text": F.length, "number": lambda c: c}
    found = value.column if value.kind == "flag" else sized[value.kind](value.column) > 0 if value.kind in sized else value.column.isNotNull()
    return Typed("flag", F.coalesce(found, F.lit(False)))


def _text(value: Any) -> Any:
    if _kind(value) not in ("text", "number"):
        raise TemplateError(f"no text: {_kind(value)}")
    if not isinstance(value, Typed):
        return str(value)
    return Typed("text", value.column.cast("string"))


def _choose(condition: Any, yes: Any, no: Any) -> Any:
    if not isinstance(condition, Typed):
        return yes if condition else no
    if yes is UNDEFINED or no is UNDEFINED:
        # a name that only one branch sets is asked for only where it was set
        return no if yes is UNDEFINED else yes
    if _kind(yes) != _kind(no):
        raise TemplateError(f"both {_kind(yes)} and {_kind(no)}")
    return Typed(_kind(yes), F.when(condition.column, _column(yes)).otherwise(_column(no)))


def _constant(*values: Any) -> bool:
    return not any(isinstance(v, Typed) for v in values)


_COMPARED: dict[type, Callable[[Any, Any], Any]] = {
    ast.Lt: lambda a, b: a < b,
    ast.Gt: lambda a, b: a > b,
    ast.LtE: lambda a, b: a <= b,
    ast.GtE: lambda a, b: a >= b,
}


class Translation:
    """Template nodes and expressions to columns; ``names`` are what is set at a place."""

    def value(self, node: ast.expr, names: Mapping[str, Any]) -> Any:
        made = getattr(self, f"_{type(node).__name__.lower()}", None)
        if made is None:
            raise TemplateError(f"not supported: {ast.unparse(node)}")
        return made(node, names)

    def _constant(self, node: ast.Constant, names: Mapping) -> Any:
        return node.value

    def _name(self, node: ast.Name, names: Mapping) -> Any:
        return {"true": True, "false": False, "none": None}.get(node.id, names.get(node.id, UNDEFINED))

    def _list(self, node: ast.List, names: Mapping) -> Any:
        return [self.value(e, names) for e in node.elts]

    _tuple = _list

    def _attribute(self, node: ast.Attribute, names: Mapping) -> Any:
        of = self.value(node.value, names)
        if isinstance(of, dict):
            return of.get(node.attr, UNDEFINED)
        return self._part(of, node.attr)

    @staticmethod
    def _part(of: Any, key: Any) -> Any:
        if _kind(of) == "message" and isinstance(key, str):
            return Typed("text", of.column[key]) if key in _FIELDS else UNDEFINED
        if _kind(of) in ("messages", "texts") and isinstance(key, int):
            at = F.try_element_at(of.column, F.lit(key + 1 if key >= 0 else key))
            return Typed({"messages": "message", "texts": "text"}[of.kind], at)
        raise TemplateError(f"no {key!r} of {_kind(of)}")

    def _subscript(self, node: ast.Subscript, names: Mapping) -> Any:
        of = self.value(node.value, names)
        if not isinstance(node.slice, ast.Slice):
            return self._part(of, self.value(node.slice, names))
        begin = self.value(node.slice.lower, names) if node.slice.lower else 0
        if _kind(of) != "messages" or not isinstance(begin, int) or begin < 0 or node.slice.upper or node.slice.step:
            raise TemplateError(f"not supported: {ast.unparse(node)}")
        left = F.greatest(F.size(of.column) - begin, F.lit(0))
        return Typed("messages", F.slice(of.column, F.lit(begin + 1), left))

    def _binop(self, node: ast.BinOp, names: Mapping) -> Any:
        if isinstance(node.op, ast.MatMult):
            return self._filtered(self.value(node.left, names), node.right)
        a, b = self.value(node.left, names), self.value(node.right, names)
        numbers = _kind(a) == _kind(b) == "number"
        if isinstance(node.op, ast.Mod) and numbers:
            return a % b if _constant(a, b) else Typed("number", F.pmod(_column(a), _column(b)))
        if isinstance(node.op, (ast.Add, ast.Sub)) and numbers:
            sign = 1 if isinstance(node.op, ast.Add) else -1
            return a + sign * b if _constant(a, b) else Typed("number", _column(a) + sign * _column(b))
        if isinstance(node.op, ast.Add):
            a, b = _text(a), _text(b)
            return a + b if _constant(a, b) else Typed("text", F.concat(_column(a), _column(b)))
        raise TemplateError(f"not supported: {ast.unparse(node)}")

    def _filtered(self, value: Any, node: ast.expr) -> Any:
        name = node.id if isinstance(node, ast.Name) else ast.unparse(node)
        if name == "safe":
            return value
        if name == "length" and _kind(value) in ("messages", "text"):
            return len(value) if _constant(value) else Typed("number", (F.size if value.kind == "messages" else F.length)(value.column))
        plain = {"trim": (str.strip, strip), "upper": (str.upper, F.upper), "lower": (str.lower, F.lower)}
        if name not in plain or _kind(value) != "text":
            raise TemplateError(f"filter {name} of {_kind(value)}")
        return plain[name][0](value) if _constant(value) else Typed("text", plain[name][1](value.column))

    def _call(self, node: ast.Call, names: Mapping) -> Any:
        given = [self.value(a, names) for a in node.args]
        if isinstance(node.func, ast.Name) and node.func.id == "raise_exception":
            return Typed("text", F.lit(None).cast("string"))
        if not isinstance(node.func, ast.Attribute) or node.keywords or not all(isinstance(g, str) for g in given):
            raise TemplateError(f"not supported: {ast.unparse(node)}")
        of, name = self.value(node.func.value, names), node.func.attr
        if _kind(of) == "text" and name in ("startswith", "endswith", "split") and len(given) == 1:
            text = _column(of)
            if name == "split":
                return Typed("texts", F.split(text, re.sub(r"([^\w\s])", r"\\\1", given[0]), -1))
            return Typed("flag", (F.startswith if name == "startswith" else F.endswith)(text, F.lit(given[0])))
        if name in ("strip", "upper", "lower") and not given:
            return self._filtered(of, ast.Name({"strip": "trim"}.get(name, name)))
        raise TemplateError(f"not supported: {ast.unparse(node)}")

    def _unaryop(self, node: ast.UnaryOp, names: Mapping) -> Any:
        value = self.value(node.operand, names)
        if isinstance(node.op, ast.USub) and isinstance(value, int):
            return -value
        if not isinstance(node.op, ast.Not):
            raise TemplateError(f"not supported: {ast.unparse(node)}")
        value = _truth(value)
        return not value if _constant(value) else Typed("flag", ~value.column)

    def _boolop(self, node: ast.BoolOp, names: Mapping) -> Any:
        both = isinstance(node.op, ast.And)
        found: Any = both
        for part in node.values:
            if found is (not both):
                # what is behind a decided part is not looked at
                break
            value = _truth(self.value(part, names))
            if _constant(value):
                found = value if value is (not both) or _constant(found) else found
            elif _constant(found):
                found = value
            else:
                found = Typed("flag", found.column & value.column if both else found.column | value.column)
        return found

    def _ifexp(self, node: ast.IfExp, names: Mapping) -> Any:
        condition = _truth(self.value(node.test, names))
        if _constant(condition):
            return self.value(node.body if condition else node.orelse, names)
        return _choose(condition, self.value(node.body, names), self.value(node.orelse, names))

    def _compare(self, node: ast.Compare, names: Mapping) -> Any:
        if len(node.ops) != 1:
            raise TemplateError(f"not supported: {ast.unparse(node)}")
        op, left = node.ops[0], self.value(node.left, names)
        if isinstance(op, (ast.Is, ast.IsNot)):
            found = self._tested(left, node.comparators[0])
        else:
            right = self.value(node.comparators[0], names)
            found = self._related(op, left, right)
        if isinstance(op, (ast.IsNot, ast.NotEq, ast.NotIn)):
            return not found if _constant(found) else Typed("flag", ~found.column)
        return found

    @staticmethod
    def _tested(value: Any, node: ast.expr) -> Any:
        name = node.id if isinstance(node, ast.Name) else str(getattr(node, "value", "")).lower()
        if name == "defined":
            return Typed("flag", value.column.isNotNull()) if _kind(value) == "message" else value is not UNDEFINED
        if name == "none":
            return Typed("flag", value.column.isNull()) if isinstance(value, Typed) else value is None
        if name == "string":
            return Typed("flag", value.column.isNotNull()) if _kind(value) == "text" and not _constant(value) else isinstance(value, str)
        raise TemplateError(f"test {name}")

    @staticmethod
    def _related(op: ast.cmpop, a: Any, b: Any) -> Any:
        if isinstance(op, (ast.Eq, ast.NotEq)):
            if _constant(a, b):
                return a == b
            if _kind(a) != _kind(b):
                return Typed("flag", _column(a).isNull() & _column(b).isNull()) if "none" in (_kind(a), _kind(b)) else False
            return Typed("flag", _column(a).eqNullSafe(_column(b)))
        if isinstance(op, (ast.In, ast.NotIn)):
            if isinstance(b, list):
                if _constant(a, *b):
                    return a in b
                either = [_column(a).eqNullSafe(_column(x)) for x in b if _kind(x) == _kind(a)]
                return Typed("flag", F.exists(F.array(*either), lambda e: e)) if either else False
            if _kind(a) == _kind(b) == "text":
                return a in b if _constant(a, b) else Typed("flag", F.coalesce(F.contains(_column(b), _column(a)), F.lit(False)))
        elif type(op) in _COMPARED and _kind(a) == _kind(b):
            found = _COMPARED[type(op)](a if _constant(a, b) else _column(a), b if _constant(a, b) else _column(b))
            return found if _constant(a, b) else Typed("flag", F.coalesce(found, F.lit(False)))
        raise TemplateError(f"cannot compare {_kind(a)} and {_kind(b)}")

    # --- nodes ---

    def text(self, nodes: list, names: dict[str, Any]) -> Any:
        """What the nodes write; ``names`` receives what they set."""
        written: list[Any] = []
        for node in nodes:
            if isinstance(node, str):
                written.append(node)
            elif isinstance(node, Set):
                names[node.name] = self.value(node.value, names)
            elif isinstance(node, For):
                written.append(self._loop(node, names))
            elif isinstance(node, If):
                written.append(self._branch(node.branches, names))
            else:
                value = self.value(node, names)
                written.append("" if value is UNDEFINED else _text(value))
        if _constant(*written):
            return "".join(written)
        return Typed("text", F.concat(*map(_column, written)))

    def _branch(self, branches: list[tuple[ast.expr | None, list]], names: dict[str, Any]) -> Any:
        if not branches:
            return ""
        test, body = branches[0]
        condition = True if test is None else _truth(self.value(test, names))
        if _constant(condition):
            return self.text(body, names) if condition else self._branch(branches[1:], names)
        yes, no = dict(names), dict(names)
        written = _choose(condition, self.text(body, yes), self._branch(branches[1:], no))
        for name in yes.keys() | no.keys():
            a, b = yes.get(name, UNDEFINED), no.get(name, UNDEFINED)
            names[name] = a if a is b else _choose(condition, a, b)
        return written

    def _loop(self, node: For, names: dict[str, Any]) -> Any:
        over = self.value(node.over, names)
        if _kind(over) != "messages":
            raise TemplateError(f"a loop over {_kind(over)}")
        size = F.size(over.column)

        def turn(message: Column, at: Column) -> Column:
            numbers = {"index0": at, "index": at + 1, "length": size}
            loop = {k: Typed("number", c) for k, c in numbers.items()}
            loop |= {"first": Typed("flag", at == 0), "last": Typed("flag", at == size - 1)}
            own = dict(names) | {node.name: Typed("message", message), "loop": loop}
            return _column(self.text(node.body, own))

        def joined(turns: Column) -> Column:
            return F.when(F.forall(turns, lambda t: t.isNotNull()), F.array_join(turns, ""))

        return Typed("text", once(F.transform(over.column, turn), joined))


@dataclass(frozen=True)
class CompiledTemplate:
    """A template text, to be used wherever a :class:`~scriptorium.operators.chat.ChatTemplate` is; ``given`` are further names."""

    source: str
    given: tuple[tuple[str, Any], ...] = (("bos_token", ""), ("eos_token", ""), ("add_generation_prompt", False))

    def rendered(self, messages: Column) -> Column:
        """Text of a chat; null for no messages and where the template raises."""
        nodes, _ = _tree(_pieces(self.source))

        def whole(chat: Column) -> Column:
            return _column(Translation().text(nodes, dict(self.given) | {"messages": Typed("messages", chat)}))

        return F.when(F.size(messages) > 0, once(messages, whole))


def compile_template(source: str, **given: str | bool | int) -> CompiledTemplate:
    """The template, checked: what cannot be translated is refused here."""
    template = CompiledTemplate(source, tuple({**dict(CompiledTemplate.given), **given}.items()))
    template.rendered(F.lit(None).cast("array<struct<role:string,content:string>>"))
    return template

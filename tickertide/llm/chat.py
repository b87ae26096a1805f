"""Chat formatting: a small sandboxed template language, compiled to Python closures.

Templates have text, {{ expression }}, {% if %} / {% elif %} / {% else %} / {% endif %},
{% for m in messages %} / {% endfor %} (one pass over the turns) and {% generation %} /
{% endgeneration %}, which marks what a model learns to say. Expressions know constants, names,
m.role and m.text, loop.first / last / index0, comparisons, and / or / not, + and filters
(value | escape). Nothing else can be reached: no calls, no other attributes, no items.

A template becomes a syntax tree, constant parts are folded (dead branches go, neighbouring texts
join), and each node becomes a closure that yields pieces. Turns are taken as a stream, and the output
is cut between turns into parts of about `part_chars`, so a conversation of any length needs little
memory: the parts of a conversation, in order, are its formatted text.

Nulls: a null text or role is empty; a null conv_id is a conversation of its own. Turns are ordered by
turn (null first), then role, then text, so ties and repeated rows have a defined order; repeated rows
are turns like any other. Empty tables give no parts. Other columns are ignored.
"""

import ast
import hashlib
import itertools
import operator
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide.llm.common import small_batches

#: Control strings of the default template; each begins with a character that escape() breaks up.
CONTROLS = ("<s>", "</s>", "[INST]", "<sep>", "[/INST]")
DEFAULT = (
    "{% for m in messages %}"
    "{% if m.role == learner %}{{ '<s>' }}{% generation %}{{ m.text | escape }}{% endgeneration %}{{ '</s>' }}"
    "{% else %}[INST]{{ m.role | escape }}<sep>{{ m.text | escape }}[/INST]{% endif %}"
    "{% endfor %}"
)
LEARNER = "assistant"


def escape(text: str) -> str:
    """No control string is left in the result; unescape() gives the text back."""
    return re.sub(r"([<\[\\])", r"\1\\", text)


def unescape(text: str) -> str:
    return re.sub(r"([<\[\\])\\", r"\1", text)


FILTERS: dict[str, Callable] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    """The template uses something the language does not have."""


# --- syntax tree ---


@dataclass
class Text:
    value: str


@dataclass
class Output:
    value: ast.expr


@dataclass
class If:
    branches: list[tuple[ast.expr | None, list]]


@dataclass
class For:
    name: str
    body: list


@dataclass
class Generation:
    body: list = field(default_factory=list)


ALLOWED = (
    ast.Constant, ast.Name, ast.Attribute, ast.Compare, ast.BoolOp, ast.UnaryOp, ast.BinOp, ast.Load, ast.Eq, ast.NotEq,
    ast.In, ast.NotIn, ast.And, ast.Or, ast.Not, ast.Add, ast.BitOr,
)
FIELDS = {"role", "text", "first", "last", "index0"}


def parse_expression(code: str) -> ast.expr:
    try:
        tree = ast.parse(code.strip(), mode="eval").body
    except SyntaxError as error:
        raise TemplateError(f"not an expression: {code}") from error
    for node in ast.walk(tree):
        if not isinstance(node, ALLOWED):
            raise TemplateError(f"{type(node).__name__} is not part of the language: {code}")
        if isinstance(node, ast.Attribute) and (node.attr not in FIELDS or not isinstance(node.value, ast.Name)):
            raise TemplateError(f"no such field: {node.attr}")
        if isinstance(node, ast.BinOp) and isinstance(node.op, ast.BitOr) and not (isinstance(node.right, ast.Name) and node.right.id in FILTERS):
            raise TemplateError(f"no such filter: {ast.unparse(node.right)}")
    return tree


def parse(source: str) -> list:
    root: list = []
    stack: list[tuple[str, object, list]] = [("root", None, root)]
    for piece in re.split(r"(\{\{.*?\}\}|\{%.*?%\})", source, flags=re.S):
        kind, node, body = stack[-1]
        if piece.startswith("{{"):
            body.append(Output(parse_expression(piece[2:-2])))
        elif piece.startswith("{%"):
            word, _, rest = piece[2:-2].strip().partition(" ")
            if word == "if":
                made = If([(parse_expression(rest), [])])
                body.append(made)
                stack.append(("if", made, made.branches[0][1]))
            elif word in ("elif", "else") and kind == "if":
                node.branches.append((parse_expression(rest) if word == "elif" else None, []))
                stack[-1] = ("if", node, node.branches[-1][1])
            elif word == "for" and (m := re.fullmatch(r"([a-z_]+) in messages", rest.strip())):
                made = For(m[1], [])
                body.append(made)
                stack.append(("for", made, made.body))
            elif word == "generation":
                made = Generation()
                body.append(made)
                stack.append(("generation", made, made.body))
            elif word == f"end{kind}" and len(stack) > 1:
                stack.pop()
            else:
                raise TemplateError(f"unexpected {piece}")
        elif piece:
            body.append(Text(piece))
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not ended")
    return root


# --- folding ---


class Folding(ast.NodeTransformer):
    """Replaces names of constants, and every part of an expression that has only constants, by their values."""

    def __init__(self, constants: dict):
        self.constants = constants

    def visit_Name(self, node):
        value = self.constants.get(node.id)
        return ast.Constant(value) if isinstance(value, str | int | bool) else node

    def visit_Attribute(self, node):
        return node

    def visit_BinOp(self, node):
        left = self.visit(node.left)
        if isinstance(node.op, ast.BitOr):
            # the right side is the filter's name
            return self._folded(ast.BinOp(left, node.op, node.right), [left])
        right = self.visit(node.right)
        return self._folded(ast.BinOp(left, node.op, right), [left, right])

    def visit_UnaryOp(self, node):
        operand = self.visit(node.operand)
        return self._folded(ast.UnaryOp(node.op, operand), [operand])

    def visit_Compare(self, node):
        left, others = self.visit(node.left), [self.visit(c) for c in node.comparators]
        return self._folded(ast.Compare(left, node.ops, others), [left, *others])

    def visit_BoolOp(self, node):
        parts: list[ast.expr] = []
        for i, part in enumerate(map(self.visit, node.values)):
            if isinstance(part, ast.Constant) and bool(part.value) == isinstance(node.op, ast.Or):
                # this part decides; later ones are not reached
                parts.append(part)
                break
            if not isinstance(part, ast.Constant) or i == len(node.values) - 1:
                parts.append(part)
        return parts[0] if len(parts) == 1 else ast.BoolOp(node.op, parts)

    def _folded(self, node, operands):
        if all(isinstance(o, ast.Constant) for o in operands):
            return ast.Constant(compile_expression(node)({}))
        return node


def fold_expression(node: ast.expr, constants: dict) -> ast.expr:
    return Folding(constants).visit(node)


def fold(body: list, constants: dict) -> list:
    out: list = []

    def add(node) -> None:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].value + node.value)
        elif not (isinstance(node, Text) and not node.value):
            out.append(node)

    for node in body:
        if isinstance(node, Output):
            value = fold_expression(node.value, constants)
            add(Text(str(value.value)) if isinstance(value, ast.Constant) else Output(value))
        elif isinstance(node, If):
            branches = []
            for test, inner in node.branches:
                test = test and fold_expression(test, constants)
                if isinstance(test, ast.Constant):
                    if not test.value:
                        continue
                    test = None
                branches.append((test, fold(inner, constants)))
                if test is None:
                    break
            if branches and branches[0][0] is None:
                for inner in branches[0][1]:
                    add(inner)
            elif branches:
                add(If(branches))
        elif isinstance(node, For):
            hidden = {k: v for k, v in constants.items() if k not in (node.name, "loop")}
            add(For(node.name, fold(node.body, hidden)))
        elif isinstance(node, Generation):
            add(Generation(fold(node.body, constants)))
        else:
            add(node)
    return out


# --- closures ---

#: Yielded after each turn: the output may be cut here.
CUT = (None, False)


def compile_body(body: list) -> Callable[[dict, bool], Iterator[tuple[str | None, bool]]]:
    parts = [compile_node(node) for node in body]

    def run(names, marked):
        for part in parts:
            yield from part(names, marked)

    return run


TESTS = {ast.Eq: operator.eq, ast.NotEq: operator.ne, ast.In: lambda a, b: a in b, ast.NotIn: lambda a, b: a not in b}


def compile_expression(node: ast.expr) -> Callable[[dict], object]:
    """A closure from names to the value; the tree is not walked again."""
    if isinstance(node, ast.Constant):
        value = node.value
        return lambda names: value
    if isinstance(node, ast.Name):
        called = node.id
        return lambda names: names[called]
    if isinstance(node, ast.Attribute):
        owner, name = node.value.id, node.attr
        return lambda names: names[owner][name]
    if isinstance(node, ast.Compare):
        return compile_comparison(node)
    if isinstance(node, ast.BoolOp):
        return compile_choice([compile_expression(part) for part in node.values], isinstance(node.op, ast.Or))
    if isinstance(node, ast.UnaryOp):
        operand = compile_expression(node.operand)
        return lambda names: not operand(names)
    left = compile_expression(node.left)
    if isinstance(node.op, ast.BitOr):
        change = FILTERS[node.right.id]
        return lambda names: change(left(names))
    right = compile_expression(node.right)
    return lambda names: left(names) + right(names)


def compile_comparison(node: ast.Compare) -> Callable[[dict], bool]:
    first = compile_expression(node.left)
    steps = [(TESTS[type(op)], compile_expression(part)) for op, part in zip(node.ops, node.comparators, strict=True)]
    if len(steps) == 1:
        test, second = steps[0]
        return lambda names: test(first(names), second(names))

    def chain(names):
        left = first(names)
        for test, part in steps:
            right = part(names)
            if not test(left, right):
                return False
            left = right
        return True

    return chain


def compile_choice(parts: list[Callable[[dict], object]], ends_on: bool) -> Callable[[dict], object]:
    """and / or: the first part whose truth is `ends_on`, else the last."""

    def choose(names):
        value = None
        for part in parts:
            value = part(names)
            if bool(value) == ends_on:
                break
        return value

    return choose


def compile_node(node):
    if isinstance(node, Text):
        value = node.value
        return lambda names, marked: iter(((value, marked),))
    if isinstance(node, Output):
        expression = compile_expression(node.value)
        return lambda names, marked: iter(((str(expression(names)), marked),))
    if isinstance(node, Generation):
        body = compile_body(node.body)
        return lambda names, marked: body(names, True)
    if isinstance(node, If):
        branches = [(test and compile_expression(test), compile_body(inner)) for test, inner in node.branches]

        def choose(names, marked):
            for test, inner in branches:
                if test is None or test(names):
                    return inner(names, marked)
            return iter(())

        return choose
    body, name = compile_body(node.body), node.name

    def repeat(names, marked):
        turns, index = iter(names["messages"]), 0
        turn = next(turns, None)
        while turn is not None:
            after = next(turns, None)
            loop = {"first": index == 0, "last": after is None, "index0": index}
            yield from body({**names, name: turn, "loop": loop}, marked)
            yield CUT
            turn, index = after, index + 1

    return repeat


class Template:
    def __init__(self, source: str = DEFAULT, **constants):
        self.source, self.constants = source, {"learner": LEARNER, **constants}
        self.tree = fold(parse(source), self.constants)
        self._run = compile_body(self.tree)

    def __reduce__(self):
        # closures do not travel; the template is compiled again in each task
        return _make, (self.source, self.constants)

    def pieces(self, turns: Iterator[dict[str, str]]) -> Iterator[tuple[str | None, bool]]:
        return self._run({**self.constants, "messages": turns}, False)

    def parts(self, turns: Iterator[dict[str, str]], part_chars: int) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        """Formatted text and its marked spans, cut between turns."""
        texts, spans, at = [], [], 0
        for text, marked in self.pieces(turns):
            if text is None:
                if at >= part_chars:
                    yield "".join(texts), spans
                    texts, spans, at = [], [], 0
                continue
            if marked:
                spans.append((at, at + len(text)))
            texts.append(text)
            at += len(text)
        yield "".join(texts), spans


def _make(source: str, constants: dict) -> Template:
    return Template(source, **constants)


# --- jobs ---

PARTS = "conv_id long, part long, formatted string, loss array<struct<start: long, end: long>>"


def format_conversations(conversations: DataFrame, template: Template | None = None, part_chars: int = 1 << 20) -> DataFrame:
    """Rows (conv_id, part, formatted, loss): loss are the marked spans (code points within the part)."""
    template = template or Template()
    small_batches(conversations.sparkSession)
    turns = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)

        out, size = [], 0
        for conv, group in itertools.groupby(rows(), key=lambda r: r[0]):
            messages = ({"role": role, "text": text} for _, role, text in group)
            for part, (text, spans) in enumerate(template.parts(messages, part_chars)):
                out.append({"conv_id": conv, "part": part, "formatted": text, "loss": [{"start": a, "end": b} for a, b in spans]})
                size += len(text)
                if size > part_chars:
                    yield _batch(out, schema)
                    out, size = [], 0
        if out:
            yield _batch(out, schema)

    schema = _arrow(PARTS)
    return ordered.mapInArrow(run, PARTS)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_MARK = re.compile("|".join(re.escape(c) for c in CONTROLS))


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn in a part made with the default template."""
    marks = list(_MARK.finditer(formatted))
    bounds = {m: (a.end(), b.start()) for m, (a, b) in enumerate(itertools.pairwise(marks))}
    for m, mark in enumerate(marks):
        if mark[0] == "<s>":
            a, b = bounds[m]
            yield LEARNER, unescape(formatted[a:b])
        elif mark[0] == "[INST]":
            a, b = bounds[m]
            c, d = bounds[m + 1]
            yield unescape(formatted[a:b]), unescape(formatted[c:d])


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of the turns and of the marked text, read from parts in their order (as format_conversations gives them)."""

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)

        out = []
        for conv, group in itertools.groupby(rows(), key=lambda r: r[0]):
            turns, loss, n, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, formatted, spans in group:
                for role, text in read_turns(formatted):
                    turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    n += 1
                for s in spans:
                    said = unescape(formatted[s["start"] : s["end"]])
                    loss.update(said.encode("utf-8", "surrogatepass"))
                    loss_chars += len(said)
                chars += len(formatted)
            out.append({"conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": loss_chars, "loss_sha256": loss.hexdigest(), "formatted_chars": chars})
            if len(out) >= 1000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    schema = _arrow(DIGESTS)
    return parts.select("conv_id", "formatted", "loss").mapInArrow(run, DIGESTS)


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)

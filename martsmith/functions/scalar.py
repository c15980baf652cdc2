"""Scalar column functions: name concatenation, JSON paths, code decoding, NaN clean-up.

Everything here returns Catalyst expressions, so it stays inside whole-stage
codegen; nothing is evaluated row by row in Python.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Payment type codes of the wallet tables and their labels.
PAYMENT_TYPE_LABELS = {1: "Bank", 2: "Credit/Debit"}


def full_name(first: str | Column, last: str | Column, sep: str = " ") -> Column:
    """``CONCAT(first, ' ', last)``: NULL when either part is NULL."""
    return F.concat(_c(first), F.lit(sep), _c(last))


def decode_codes(code: str | Column, labels: Mapping[object, str]) -> Column:
    """Searched CASE: each code maps to its label, anything else (and NULL) to NULL."""
    c = _c(code)
    expr = None
    for value, label in labels.items():
        expr = (F.when(c == F.lit(value), F.lit(label)) if expr is None
                else expr.when(c == F.lit(value), F.lit(label)))
    if expr is None:
        return F.lit(None).cast("string")
    return expr


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL for a floating point column; NULL and +-Infinity stay as they are."""
    col = _c(c)
    return F.when(~F.isnan(col), col)


def collated(c: str | Column, collation: str | None) -> Column:
    """A string expression under a collation (``UTF8_LCASE``, ``UNICODE_CI_AI``...);
    ``None`` keeps binary comparison."""
    col = _c(c)
    return col if not collation else F.collate(col, collation)


_PATH = re.compile(r"\$((?:\.[A-Za-z_][A-Za-z0-9_]*|\[\d+\])+)")
_STEP = re.compile(r"\.([A-Za-z_][A-Za-z0-9_]*)|\[(\d+)\]")


def path_steps(path: str) -> list[str | int]:
    """The keys and indices of a JSON path such as ``$.a.b[0].c``."""
    whole = _PATH.fullmatch(path)
    if not whole:
        raise ValueError(f"unsupported JSON path {path!r}")
    return [key or int(index) for key, index in _STEP.findall(whole.group(1))]


def path_tree(paths: Mapping[str, str]) -> dict:
    """Paths by their common beginnings: step -> subtree, and under ``None`` the outputs that end there."""
    tree: dict = {}
    for out, path in paths.items():
        node = tree
        for step in path_steps(path):
            node = node.setdefault(step, {})
        node.setdefault(None, []).append(out)
    return tree


def json_fields(
    df: DataFrame,
    doc: str,
    paths: Mapping[str, str],
    json_null: str = "sql",
    keep_doc: bool = False,
) -> DataFrame:
    """Add one string column per JSON path of ``doc`` (``JSON_UNQUOTE(JSON_EXTRACT(...))``).

    ``paths`` maps output column -> path, any mix of keys and indices. The document is tokenised once per row by a single
    ``json_tuple`` over all top-level keys; paths that go on read the raw text it returns for their key, one step at a time
    along the tree of paths, so that a common beginning is cut out once. Paths that begin with an index take the document itself.

    Missing keys, JSON ``null``, empty lists and malformed documents give NULL.
    With ``json_null="literal"`` a JSON ``null`` value gives the string
    ``'null'`` instead (the behaviour of a server that unquotes the literal): that takes one parse of the
    document more, which all paths share.
    """
    if json_null not in ("sql", "literal"):
        raise ValueError("json_null must be 'sql' or 'literal'")
    tree = path_tree(paths)
    keys = [k for k in tree if isinstance(k, str)]
    made: dict[str, str] = {}

    def fresh(what: str) -> str:
        made[what] = f"__json_{len(made)}"
        return made[what]

    parsed = df
    if keys:
        parsed = parsed.select("*", F.json_tuple(F.col(doc), *keys).alias(*[fresh(f"$.{k}") for k in keys]))
    if json_null == "literal":
        parsed = parsed.withColumn("__json_doc", F.try_parse_json(F.col(doc)))
    found: dict[str, Column] = {}

    def walk(node: dict, text: Column, rest: str, path: str) -> None:
        """Outputs below ``node``: at ``rest`` of the text; a place where paths part gets a column of its own."""
        nonlocal parsed
        for out in node.get(None, []):
            found[out] = F.get_json_object(text, f"${rest}") if rest else text
        below = [s for s in node if s is not None]
        if rest and len(below) + len(node.get(None, [])) > 1 and path:
            parsed = parsed.withColumn(fresh(path), F.get_json_object(text, f"${rest}"))
            text, rest = F.col(made[path]), ""
        for step in below:
            here = f".{step}" if isinstance(step, str) else f"[{step}]"
            walk(node[step], text, rest + here, path + here)

    for step, node in tree.items():
        if isinstance(step, str):
            walk(node, F.col(made[f"$.{step}"]), "", f"$.{step}")
        else:
            walk(node, F.col(doc), f"[{step}]", f"$[{step}]")
    if json_null == "literal":
        found = {out: F.when(F.expr(f"is_variant_null(variant_get(__json_doc, '{paths[out]}'))"), F.lit("null")).otherwise(value) for out, value in found.items()}
        made["doc"] = "__json_doc"
    result = parsed.withColumns({out: found[out] for out in paths}).drop(*made.values())
    return result if keep_doc else result.drop(doc)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c

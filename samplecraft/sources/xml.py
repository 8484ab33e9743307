"""XML of any shape as payloads: no schema is given, documents of a table may all differ."""

from __future__ import annotations

import json
from collections.abc import Callable
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ATTRIBUTE = "-"
CONTENT = "#content"


class _Refused(Exception):
    """A document that declares entities of its own, which could grow without bound."""


def xml_to_json(text: str, attribute: str = ATTRIBUTE, content: str = CONTENT, prefixes: bool = False) -> str | None:
    """An XML document as JSON text, null if it is not well-formed; every value is text.

    An element with attributes or children is an object: attributes are named ``-name``, its text ``#content``,
    children of one name are a list if there are several. Any other element is its text, the empty text if it has none.
    The root is the one key of the document. Text is trimmed, pieces between children are joined by a blank, blank ones
    dropped; character references, CDATA and comments are resolved. Names stand without namespace prefix, unless
    ``prefixes``; of attributes that become equal by that the last wins.

    Elements are put together as they end, so depth needs no stack of calls.
    """
    quoted = json.dumps
    name_of: Callable[[str], str] = (lambda n: n) if prefixes else (lambda n: n.rpartition(":")[2])
    # of each open element: name, fields as finished JSON by name, pieces of text
    stack: list[tuple[str, dict[str, list[str]], list[str]]] = [("", {}, [])]
    parser = expat.ParserCreate("utf-8")
    parser.buffer_text = True

    def start(name: str, attributes: dict[str, str]) -> None:
        stack.append((name_of(name), {attribute + name_of(k): [quoted(v)] for k, v in attributes.items()}, []))

    def chars(data: str) -> None:
        stack[-1][2].append(data)

    def cut_text() -> None:
        """Pieces that children part are trimmed apart."""
        pieces = stack[-1][2]
        if pieces and pieces[-1] is not None:
            pieces.append(None)

    def end(_: str) -> None:
        name, fields, pieces = stack.pop()
        parts = "".join("\0" if p is None else p for p in pieces).split("\0")
        words = " ".join(p for p in (p.strip() for p in parts) if p)
        if fields:
            if words:
                fields[content] = [quoted(words)]
            made = "{" + ",".join(f"{quoted(k)}:{v[0] if len(v) == 1 else '[' + ','.join(v) + ']'}" for k, v in fields.items()) + "}"
        else:
            made = quoted(words)
        stack[-1][1].setdefault(name, []).append(made)
        cut_text()

    def refuse(*_: object) -> None:
        raise _Refused

    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, chars
    parser.EntityDeclHandler = refuse
    try:
        parser.Parse(text.lstrip("﻿ \t\r\n"), True)
    except (expat.ExpatError, _Refused, ValueError):
        return None
    return "{" + ",".join(f"{quoted(k)}:{v[0]}" for k, v in stack[0][1].items()) + "}"


def xml_json(body: Column, attribute: str = ATTRIBUTE, content: str = CONTENT, prefixes: bool = False) -> Column:
    """JSON text of an XML column; only this column goes through Python, in Arrow batches."""

    @F.arrow_udf("string")
    def convert(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else xml_to_json(t, attribute, content, prefixes) for t in texts.to_pylist()], pa.string())

    return convert(body)


def parse_any_xml(df: DataFrame, body: str = "body", payload: str = "payload", **options: object) -> DataFrame:
    """XML text -> ``VARIANT`` payload; what is not well-formed gives a null payload (see ``xml_to_json``)."""
    return df.withColumn(payload, F.try_parse_json(xml_json(F.col(body), **options)))

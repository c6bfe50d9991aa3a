"""Tool definitions from OpenAPI documents, JSON, Python modules and functions.

Definitions are small driver-side metadata; ``frame`` makes them a DataFrame.
"""

from __future__ import annotations

import ast
import inspect
import json
import re

from pyspark.sql import DataFrame, SparkSession

from .readers import TOOL_SCHEMA

# How foreign type names map.
JSON_TYPES = {"string": "string", "number": "number", "integer": "integer", "boolean": "boolean", "array": "array", "object": "object"}
PYTHON_TYPES = {"str": "string", "int": "integer", "float": "number", "bool": "boolean", "list": "array", "dict": "object", "List": "array", "Dict": "object", "Any": "any"}
METHODS = ("get", "post", "put", "patch", "delete")


def _by_count(n: int, medium: int, complex_: int) -> str:
    return "complex" if n > complex_ else "medium" if n > medium else "simple"


def _tool(tool_id: str, name: str, description: str, parameters: list[dict], returns: dict | None = None, category: str | None = None, complexity: str = "simple", url: str | None = None, examples: list | None = None) -> dict:
    text = lambda v: v if v is None or isinstance(v, str) else json.dumps(v)
    plain = [{"name": p.get("name"), "type": p.get("type") or "string", "description": p.get("description") or "", "required": bool(p.get("required")), "default": text(p.get("default")), "enum": None if p.get("enum") is None else [text(v) for v in p["enum"]]} for p in parameters]
    return {"tool_id": tool_id, "name": name, "description": description, "parameters": plain, "returns": returns or {"type": "any", "description": ""}, "category": category, "complexity": complexity, "documentation_url": url, "examples": [v if isinstance(v, str) else json.dumps(v) for v in examples or []]}


def _resolve(spec: dict, node: dict) -> dict:
    seen = set()
    while isinstance(node, dict) and "$ref" in node and node["$ref"] not in seen:
        seen.add(node["$ref"])
        found = spec
        for part in node["$ref"].lstrip("#/").split("/"):
            found = found.get(part, {}) if isinstance(found, dict) else {}
        node = found
    return node or {}


def openapi(spec: dict) -> list[dict]:
    """A tool for each operation: its parameters and the properties of its JSON body."""
    out = []
    for path, item in (spec.get("paths") or {}).items():
        for method in METHODS:
            op = (item or {}).get(method)
            if not op:
                continue
            parameters = []
            for p in [*item.get("parameters", []), *op.get("parameters", [])]:
                p = _resolve(spec, p)
                kind = _resolve(spec, p.get("schema", {}))
                parameters.append({"name": p.get("name"), "type": JSON_TYPES.get(kind.get("type"), "string"), "description": p.get("description"), "required": p.get("required"), "default": kind.get("default"), "enum": kind.get("enum")})
            body = _resolve(spec, _resolve(spec, op.get("requestBody", {})).get("content", {}).get("application/json", {}).get("schema", {}))
            for name, kind in (body.get("properties") or {}).items():
                kind = _resolve(spec, kind)
                parameters.append({"name": name, "type": JSON_TYPES.get(kind.get("type"), "string"), "description": kind.get("description"), "required": name in body.get("required", []), "default": kind.get("default"), "enum": kind.get("enum")})
            name = op.get("operationId") or f"{method}_{path}".strip("/").replace("/", "_")
            out.append(_tool(re.sub(r"\W+", "_", name).strip("_").lower(), name, op.get("summary") or op.get("description") or "", parameters, category=(op.get("tags") or [None])[0], complexity=_by_count(len(parameters), 5, 10)))
    return out


def json_tools(data) -> list[dict]:
    """Tools of a list, an object with ``tools``, or a single object; parameters as a list or a JSON schema."""
    listed = data if isinstance(data, list) else data["tools"] if "tools" in data else [data]
    out = []
    for i, t in enumerate(listed):
        t = t.get("function", t)
        given = t.get("parameters") or []
        if isinstance(given, dict):
            given = [{**p, "name": n, "required": n in given.get("required", [])} for n, p in given.get("properties", {}).items()]
        name = t.get("name") or f"tool_{i}"
        out.append(_tool(t.get("tool_id") or t.get("id") or name.lower().replace(" ", "_"), name, t.get("description") or "", given, t.get("returns"), t.get("category") or "general", t.get("complexity") or "simple", t.get("documentation_url"), t.get("examples")))
    return out


_SECTION = re.compile(r"(?m)^(Args|Arguments|Parameters|Returns|Raises):[ \t]*$")
_ENTRY = re.compile(r"(?m)^[ \t]*\*{0,2}(\w+)[ \t]*(?:\([^)]*\))?:[ \t]*")


def _one_line(text: str) -> str:
    return " ".join(text.split())


def docstring_parts(doc: str | None) -> dict:
    """``description``, ``args`` by name, and ``returns`` of a docstring with headed sections.

    The text is split at its headings first.  In a section of arguments an
    entry goes on until the next one that begins at the least indentation.
    """
    opening, *rest = _SECTION.split(inspect.cleandoc(doc or ""))
    sections = dict(zip(rest[::2], rest[1::2], strict=True))
    args: dict[str, str] = {}
    for heading in ("Args", "Arguments", "Parameters"):
        body = inspect.cleandoc("\n" + sections.get(heading, ""))
        entries = [e for e in re.split(r"(?m)^(?=\S)", body) if e.strip()]
        for entry in entries:
            if found := _ENTRY.match(entry):
                args[found[1]] = _one_line(entry[found.end() :])
    return {"description": _one_line(opening), "args": args, "returns": _one_line(sections.get("Returns", ""))}


def _python_type(annotation: str | None) -> str:
    return PYTHON_TYPES.get(re.split(r"[\[|. ]", (annotation or "any").replace("typing.", "").replace("Optional[", ""))[0].rstrip("]"), "any")


def _literal(node: ast.expr):
    try:
        return ast.literal_eval(node)
    except ValueError:
        return ast.unparse(node)


def python_module(source: str) -> list[dict]:
    """A tool for each public function of a module's source, nested ones and methods as well, in the order of the source."""
    out = []
    functions = [n for n in ast.walk(ast.parse(source)) if isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef)) and not n.name.startswith("_")]
    for node in sorted(functions, key=lambda n: n.lineno):
        doc = docstring_parts(ast.get_docstring(node))
        places = node.args.posonlyargs + node.args.args
        defaults = dict(zip([a.arg for a in places[len(places) - len(node.args.defaults) :]], map(_literal, node.args.defaults), strict=True))
        defaults |= {a.arg: _literal(d) for a, d in zip(node.args.kwonlyargs, node.args.kw_defaults, strict=True) if d is not None}
        named = [a for a in places + node.args.kwonlyargs if a.arg not in ("self", "cls")]
        parameters = [{"name": a.arg, "type": _python_type(ast.unparse(a.annotation) if a.annotation else None), "description": doc["args"].get(a.arg), "required": a.arg not in defaults, "default": defaults.get(a.arg)} for a in named]
        out.append(_tool(node.name, node.name, doc["description"] or f"Function {node.name}", parameters, {"type": _python_type(ast.unparse(node.returns) if node.returns else None), "description": doc["returns"]}, "python", _by_count(len(parameters), 3, 6)))
    return out


def function(f) -> dict:
    """A tool from a Python function's signature."""
    doc, parameters = docstring_parts(f.__doc__), []
    for p in inspect.signature(f).parameters.values():
        kind = None if p.annotation is p.empty else p.annotation if isinstance(p.annotation, str) else getattr(p.annotation, "__name__", None)
        parameters.append({"name": p.name, "type": _python_type(kind), "description": doc["args"].get(p.name), "required": p.default is p.empty, "default": None if p.default is p.empty else p.default})
    return _tool(f.__name__, f.__name__, doc["description"] or f"Function {f.__name__}", parameters, category="python", complexity="simple" if len(parameters) <= 3 else "medium")


def load(text: str, kind: str) -> list[dict]:
    """Tools of a file's text; ``kind`` is ``openapi``, ``json`` or ``python``."""
    if kind == "python":
        return python_module(text)
    try:
        data = json.loads(text)
    except ValueError:
        import yaml

        data = yaml.safe_load(text)
    if kind == "openapi":
        return openapi(data)
    if kind == "json":
        return json_tools(data)
    raise ValueError(f"unknown kind of tool file: {kind}")


def frame(spark: SparkSession, tools: list[dict]) -> DataFrame:
    """Tools as rows with their place ``idx``."""
    return spark.createDataFrame([{"idx": i, **t} for i, t in enumerate(tools)], f"idx long, {TOOL_SCHEMA}")

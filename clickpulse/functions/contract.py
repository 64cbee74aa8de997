"""Compile a JSON-Schema (Draft-07 subset) contract into Column rules.

Only the keywords the two contracts use are supported: type, required,
properties, additionalProperties=false, const, enum, minLength, maxLength,
minimum, format (uuid, date-time) and array items.  The compile step runs
once on the driver over a small dict; the resulting expressions run on the
executors inside whole-stage codegen.

Errors are reported like the Python ``jsonschema`` validator the contract was
written for: ``"[path]: message"`` with path ``a -> b`` or ``root``, one per
violated keyword, in schema keyword order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickpulse.functions import jsonval as J
from clickpulse.functions.timefmt import is_rfc3339

UUID_RE = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


@dataclass(frozen=True)
class Rule:
    path: str        # "root", "user_id", "validation_errors -> *"
    keyword: str     # JSON-Schema keyword
    error: Column    # message text when violated, else null (or array for items)
    many: bool = False  # error is an array of messages (per-item rules)
    cond: Column | None = None  # violation condition (cheap boolean)


def _py_literal(x) -> str:
    if isinstance(x, str):
        return "'" + x + "'"
    if isinstance(x, list):
        return "[" + ", ".join(_py_literal(i) for i in x) + "]"
    if isinstance(x, bool):
        return "True" if x else "False"
    return str(x)


def _type_ok(k: Column, types) -> Column:
    types = types if isinstance(types, list) else [types]
    ok = F.lit(False)
    for t in types:
        if t == "number":
            ok = ok | k.isin("integer", "number")
        else:
            ok = ok | (k == t)
    return ok


# Messages of a property carry this marker where the value's Python repr
# goes; the repr is rendered once per property, only when it has errors.
VALUE_MARK = "\u0000"


TAG_SEP = "\u0001"


def _msg(path: str, text: Column, kw: str = "") -> Column:
    """``<path:keyword>SEP[path]: text`` - the tag travels with the message so
    messages and violated-rule tags come from one evaluation."""
    tag = (path if path != "root" or kw else path) + ":" + kw
    return F.concat(F.lit(f"{tag}{TAG_SEP}[{path}]: "), text)


def _rule(path: str, kw: str, cond: Column, msg: Column) -> Rule:
    return Rule(path, kw, F.when(cond, msg), cond=cond)


def _value_rules(v: Column, schema: dict, path: str, enforce_datetime: bool,
                 k: Column | None = None, sval: Column | None = None) -> list[Rule]:
    """Rules of one (sub)schema applied to the variant ``v`` (null = absent);
    ``k`` is its precomputed kind, ``sval`` its text when it is a string."""
    rules: list[Rule] = []
    k = J.kind(v) if k is None else k
    sval = J.as_string(v) if sval is None else sval
    present = v.isNotNull()
    for kw, arg in schema.items():
        if kw == "type":
            types = arg if isinstance(arg, list) else [arg]
            txt = F.lit(VALUE_MARK + " is not of type " + ", ".join(_py_literal(t) for t in types))
            rules.append(_rule(path, kw, present & ~_type_ok(k, arg), _msg(path, txt, kw)))
        elif kw == "const":
            same = F.coalesce(sval == F.lit(arg), F.lit(False)) if isinstance(arg, str) else F.lit(False)
            rules.append(_rule(path, kw, present & ~same, _msg(path, F.lit(_py_literal(arg) + " was expected"), kw)))
        elif kw == "enum":
            ok = F.coalesce(sval.isin(*arg), F.lit(False))
            txt = F.lit(VALUE_MARK + " is not one of " + _py_literal(arg))
            rules.append(_rule(path, kw, present & ~ok, _msg(path, txt, kw)))
        elif kw in ("minLength", "maxLength"):
            n = F.char_length(sval)
            bad = (n < arg) if kw == "minLength" else (n > arg)
            if kw == "minLength":
                word = " should be non-empty" if arg == 1 else " is too short"
            else:
                word = " is too long"
            rules.append(_rule(path, kw, present & (k == "string") & F.coalesce(bad, F.lit(False)),
                               _msg(path, F.lit(VALUE_MARK + word), kw)))
        elif kw == "minimum":
            num = F.variant_get(v, "$", "double")
            bad = k.isin("integer", "number") & (num < F.lit(arg))
            txt = F.lit(VALUE_MARK + f" is less than the minimum of {arg!r}")
            rules.append(_rule(path, kw, present & F.coalesce(bad, F.lit(False)), _msg(path, txt, kw)))
        elif kw == "format":
            s = sval
            if arg == "uuid":
                ok = s.rlike(UUID_RE)
            elif arg == "date-time":
                if not enforce_datetime:
                    continue
                ok = is_rfc3339(s)
            else:
                continue
            txt = F.lit(VALUE_MARK + f" is not a {arg!r}")
            rules.append(_rule(path, kw, present & (k == "string") & ~F.coalesce(ok, F.lit(False)),
                               _msg(path, txt, kw)))
        elif kw == "items":
            # One message per offending item, path "<array> -> <index>".
            items = F.try_variant_get(v, "$", "array<variant>")
            sub = arg
            base = path

            def make_item_rule(sub, base):
                return lambda x, i: _item_error(x, i, sub, base)

            per_item = make_item_rule(sub, base)
            errs = F.filter(F.transform(items, per_item), lambda e: e.isNotNull())
            rules.append(Rule(path + " -> *", kw, F.when(present & (k == "array"), errs), many=True,
                              cond=present & (k == "array") & (F.size(errs) > 0)))
    return rules


def _item_error(x, i, sub, base):
    xk = J.kind(x)
    ipath = F.concat(F.lit(f"{base}:items{TAG_SEP}[{base} -> "), i.cast("string"), F.lit("]: "))
    t = sub.get("type")
    if t is None:
        return F.lit(None).cast("string")
    txt = F.concat(J.py_repr(x), F.lit(" is not of type " + ", ".join(
        _py_literal(tt) for tt in (t if isinstance(t, list) else [t]))))
    return F.when(~_type_ok(xk, t), F.concat(ipath, txt))


def value_columns(contract: dict, doc: Column, raw: Column | None = None) -> dict:
    """Per-property value variant, kind and string text, plus the root kind,
    to be computed once and fenced.  The root kind comes from the first
    character of the raw text when it is given (serializing or typing the
    whole document would cost more than the parse)."""
    root = J.kind(doc) if raw is None else F.when(doc.isNotNull(), J.root_kind(raw))
    cols = {"_root_kind": root}
    for name in contract.get("properties", {}):
        v = J.field(doc, name)
        cols["_v_" + name] = v
        cols["_k_" + name] = J.kind(v)
        cols["_s_" + name] = F.when(F.schema_of_variant(v) == "STRING", F.variant_get(v, "$", "string"))
    return cols


def _property_rules(v: Column, sub: dict, name: str, enforce_datetime: bool,
                    k: Column | None = None, sval: Column | None = None) -> list[Rule]:
    """Rules of one property with the value repr substituted once."""
    rules = _value_rules(v, sub, name, enforce_datetime, k, sval)
    plain = [r for r in rules if not r.many]
    many = [r for r in rules if r.many]
    if not plain:
        return many
    errs = F.filter(F.array(*[r.error for r in plain]), lambda e: e.isNotNull())
    # the repr is only rendered inside the lambda, i.e. for error rows
    shown = F.transform(errs, lambda e: F.replace(e, F.lit(VALUE_MARK), J.py_repr(v)))
    any_plain = plain[0].cond
    for r in plain[1:]:
        any_plain = any_plain | r.cond
    return [Rule(name, "*", shown, many=True, cond=any_plain)] + many


def compile_contract(contract: dict, doc: Column, enforce_datetime: bool = True,
                     values: dict | None = None) -> list[Rule]:
    """Rules of an object contract over the document variant ``doc``.

    ``values`` may hold precomputed ``value_columns`` (as attributes)."""
    rules: list[Rule] = []
    values = values or value_columns(contract, doc)
    root_kind = values["_root_kind"]
    is_obj = root_kind == "object"
    props = contract.get("properties", {})
    for kw, arg in contract.items():
        if kw == "type":
            txt = F.concat(J.py_repr(doc), F.lit(f" is not of type {_py_literal(arg)}"))
            rules.append(_rule("root", kw, doc.isNotNull() & (root_kind != arg), _msg("root", txt, kw)))
        elif kw == "required":
            for f in arg:
                fv = values.get("_v_" + f, J.field(doc, f))
                rules.append(_rule("root", kw, is_obj & fv.isNull(),
                                   F.lit(f"root:required{TAG_SEP}[root]: '{f}' is a required property")))
        elif kw == "properties":
            for name, sub in arg.items():
                v = F.when(is_obj, values["_v_" + name])
                k = F.when(is_obj, values["_k_" + name]) if "_k_" + name in values else None
                sv = F.when(is_obj, values["_s_" + name]) if "_s_" + name in values else None
                rules.extend(_property_rules(v, sub, name, enforce_datetime, k, sv))
        elif kw == "additionalProperties" and arg is False:
            keys = F.map_keys(F.try_variant_get(doc, "$", "map<string,variant>"))
            extra = F.array_except(keys, F.array(*[F.lit(p) for p in props]))
            n = F.size(extra)
            listed = F.array_join(F.transform(extra, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", ")
            txt = F.concat(F.lit("Additional properties are not allowed ("), listed,
                           F.when(n == 1, F.lit(" was unexpected)")).otherwise(F.lit(" were unexpected)")))
            rules.append(_rule("root", kw, is_obj & (n > 0), _msg("root", txt, kw)))
    return rules


def tagged_errors(contract: dict, doc: Column, enforce_datetime: bool = True,
                  values: dict | None = None) -> Column:
    """ARRAY<STRING> of ``tag SEP message`` for every violation, in keyword
    order (empty = valid)."""
    parts = []
    for r in compile_contract(contract, doc, enforce_datetime, values):
        parts.append(F.coalesce(r.error, F.array().cast("array<string>")) if r.many
                     else F.array(r.error))
    return F.filter(F.flatten(F.array(*parts)), lambda e: e.isNotNull())


def messages_of(tagged: Column) -> Column:
    return F.transform(tagged, lambda e: F.substring_index(e, TAG_SEP, -1))


def tags_of(tagged: Column) -> Column:
    return F.transform(tagged, lambda e: F.substring_index(e, TAG_SEP, 1))


def contract_errors(contract: dict, doc: Column, enforce_datetime: bool = True,
                    values: dict | None = None) -> Column:
    """ARRAY<STRING> of every violation message (empty = valid)."""
    return messages_of(tagged_errors(contract, doc, enforce_datetime, values))


def any_violation(contract: dict, doc: Column, enforce_datetime: bool = True,
                  values: dict | None = None) -> Column:
    """One boolean: does the document violate any rule?  Cheap conditions
    only - messages are assembled just for the rows where this is true."""
    out = None
    for r in compile_contract(contract, doc, enforce_datetime, values):
        c = F.coalesce(r.cond, F.lit(False))
        out = c if out is None else (out | c)
    return out

"""Identities and fingerprints as column expressions: digests of canonical JSON.

Canonical: keys in order, no blanks, nulls written as such, text beyond ASCII kept. So no two different values share a
text, and a null is never the same as an absent or an empty one. (Control characters without an escape of their own are
written as \\u with upper-case hexadecimal digits.)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Parts of a parser manifest that count whether used or not (fixed values).
ALWAYS = ["algorithm", "adapter", "fetch", "markdown"]
#: Fields of an input that its meaning depends on, and of a delivery that its business content consists of (fixed values).
INPUT_FIELDS = ["role", "semantic_locator", "slice_hash", "charset", "base_url", "volume_order", "context"]
CONTENT_FIELDS = ["metadata", "dates", "deliverables", "tables", "links", "media", "extensions"]


def scalar(value: Column | str) -> Column:
    """The JSON text of a string, number or boolean; ``null`` for null."""
    one = F.to_json(F.array(F.col(value) if isinstance(value, str) else value))
    return F.substring(one, F.lit(2), F.char_length(one) - 2)


def members(fields: dict[str, Column]) -> Column:
    """An object of JSON texts, its keys in order."""
    parts = [F.concat(F.lit(f'"{k}":'), fields[k]) for k in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def items(values: Column) -> Column:
    """An array of JSON texts, in the order given."""
    return F.concat(F.lit("["), F.array_join(values, ","), F.lit("]"))


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def tagged(kind: str, value: Column, algorithm: str = "docloom.fingerprint.v1") -> Column:
    """The fingerprint of a JSON value of a kind."""
    return digest(members({"algorithm": F.lit(f'"{algorithm}"'), "kind": F.lit(f'"{kind}"'), "value": value}))


def request_key(method: Column, public_url: Column, form: Column, role: Column) -> Column:
    """A request's key from its method, whole public URL, form (JSON text; null: none) and role; null where the URL is refused."""
    told = {"algorithm": F.lit('"docloom.request-key.v1"'), "method": scalar(method), "url": scalar(public_url), "form": scalar(digest(form)), "role": scalar(role)}
    return F.when(public_url.isNotNull(), digest(members(told)))


def record_hash(source: Column, namespace: Column, external_key: Column) -> Column:
    """A source's record by its namespace and key."""
    return digest(members({"algorithm": F.lit('"docloom.source-record.v1"'), "source_id": scalar(source), "namespace": scalar(namespace), "external_key": scalar(external_key)}))


def input_fingerprint(namespace: Column, external_key: Column, inputs: Column) -> Column:
    """Of an identity and the seven meaningful fields of its inputs (an array of structs), in an order of their own."""
    texts = F.array_sort(F.transform(inputs, lambda x: members({k: scalar(x[k]) if k != "context" else F.coalesce(x[k], F.lit("{}")) for k in INPUT_FIELDS})))
    return tagged("input", members({"namespace": scalar(namespace), "external_key": scalar(external_key), "inputs": items(texts)}))


def effective_manifest(manifest: Column, used: Column) -> Column:
    """The JSON text of the part of a manifest (a map of JSON texts) that always counts or was used."""
    kept = F.map_filter(manifest, lambda k, _: k.isin(ALWAYS) | F.array_contains(used, k))
    pairs = F.array_sort(F.transform(F.map_entries(kept), lambda e: F.concat(scalar(e["key"]), F.lit(":"), e["value"])))
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def version_fingerprint(input_fp: Column, parser_fp: Column) -> Column:
    """Of what went in and what parsed it."""
    return tagged("version", members({"input": scalar(input_fp), "parser": scalar(parser_fp)}))


def content_hash(business: dict[str, Column]) -> Column:
    """Of the business fields (JSON texts; those not told are empty)."""
    empty = {k: F.lit("{}" if k in ("metadata", "dates", "extensions") else "[]") for k in CONTENT_FIELDS}
    return tagged("content", members({**empty, **business}))


def target_key(namespace: Column, external_key: Column, request_keys: Column) -> Column:
    """A target's key from its identity if both parts are told, else from its inputs' request keys."""
    named = (F.coalesce(namespace, F.lit("")) != "") & (F.coalesce(external_key, F.lit("")) != "")
    by_inputs = digest(members({"inputs": items(F.transform(request_keys, scalar))}))
    return F.when(named, digest(members({"namespace": scalar(namespace), "external_key": scalar(external_key)}))).otherwise(by_inputs)


def replay_key(target: Column, payload: Column) -> Column:
    """The key of a later occurrence of a target with another payload (JSON text)."""
    return digest(members({"algorithm": F.lit('"docloom.delivery-replay.v1"'), "target": scalar(target), "payload": payload}))

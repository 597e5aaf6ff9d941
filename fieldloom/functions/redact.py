"""Secret redaction in text and JSON, and a report by pattern."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = "[redacted]"
#: Secret shapes in the order in which they are replaced.
PATTERNS = [
    ("jwt", r"eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+"),
    ("access_key_id", r"AKIA[0-9A-Z]{16}"),
    ("temporary_key_id", r"ASIA[0-9A-Z]{16}"),
    ("session_token", r"\b(?:FwoG|IQoJ)[A-Za-z0-9+/=]{16,}"),
    ("refresh_token", r"\b1//[A-Za-z0-9_\-]{20,}"),
    ("private_key_block", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |ENCRYPTED |)PRIVATE KEY-----[\s\S]*?-----END (?:RSA |EC |DSA |OPENSSH |ENCRYPTED |)PRIVATE KEY-----"),
    ("private_key_id", r'(?i)"private_key_id"\s*:\s*"[^"]+"'),
    ("secret_access_key", r"(?i)\b(?:aws[_-]?secret[_-]?access[_-]?key|secretaccesskey)[\"']?\s*[:=]\s*[\"']?[A-Za-z0-9/+=]{20,}"),
    ("prefixed_key", r"\b(?:sk|pk|secret|key|token)_(?:live|test|prod)?_?[A-Za-z0-9]{16,}"),
    ("hyphenated_key", r"\bsk-[A-Za-z0-9][A-Za-z0-9_\-]{20,}"),
    ("hex40", r"\b[a-f0-9]{40}\b"),
    ("bearer", r"(?i)\bbearer\s+[A-Za-z0-9_.\-+/=]+"),
    ("api_key_header", r"(?i)X-[A-Za-z]+-Api-Key[\"']?\s*[:=]\s*[\"']?[A-Za-z0-9_\-]+"),
    ("resource_name", r"arn:aws[a-z0-9\-]*:[a-z0-9\-]*:[a-z0-9\-]*:[0-9]*:[A-Za-z0-9_\-./:*]+"),
]
#: Normalised names of fields that hold secrets.
SENSITIVE = [
    "awssecretaccesskey", "secretaccesskey", "awsaccesskeyid", "accesskeyid", "awssessiontoken", "apikey", "authorization", "auth", "token",
    "accesstoken", "refreshtoken", "sessiontoken", "idtoken", "secret", "password", "passwd", "pwd", "credentials", "privatekey", "privatekeyid", "clientsecret",
]
HEADER_KEY = re.compile(r"x[a-z]+apikey")
#: What each secret shape cannot do without: literals of the text, or of its lower-cased form. A run of hex digits has none and is looked for by itself.
LITERALS = {
    "jwt": ["eyJ"], "access_key_id": ["AKIA"], "temporary_key_id": ["ASIA"], "session_token": ["FwoG", "IQoJ"], "refresh_token": ["1//"], "private_key_block": ["PRIVATE KEY-----"],
    "prefixed_key": ["sk_", "pk_", "secret_", "key_", "token_"], "hyphenated_key": ["sk-"], "resource_name": ["arn:aws"],
}
LOWERED = {"private_key_id": ["private_key_id"], "secret_access_key": ["secret"], "bearer": ["bearer"], "api_key_header": ["-api-key"]}


def may_hold(col: Column, name: str) -> Column:
    """Whether a text can hold a secret of this shape: plain searches for its literals. A replaced secret leaves none of them, so the test of the original text also
    holds for what earlier patterns have left of it."""
    if name == "hex40":
        return col.rlike("[a-f0-9]{40}")
    text = col if name in LITERALS else F.lower(col)
    hit = None
    for literal in LITERALS.get(name) or LOWERED[name]:
        one = F.contains(text, F.lit(literal))
        hit = one if hit is None else hit | one
    return hit


def redact_text(col):
    """Every secret shape replaced; null stays null. Texts without any shape's literals or run of hex digits skip the chain."""
    out, some = col, None
    for name, p in PATTERNS:
        out = F.regexp_replace(out, p, TOKEN)
        one = may_hold(col, name)
        some = one if some is None else some | one
    return F.when(some, out).otherwise(col)


def secret_report(df: DataFrame, column: str) -> DataFrame:
    """pattern, rows that match, matches. One pass with partial aggregates, then a row for each pattern; only the patterns whose literals a text has are counted in it."""
    text = F.col("t")
    counts = df.select(F.col(column).alias("t")).select(*[F.when(may_hold(text, name), F.regexp_count(text, F.lit(p))).otherwise(0).alias(name) for name, p in PATTERNS])
    one = counts.agg(*[x for name, _ in PATTERNS for x in (F.count_if(F.col(name) > 0).alias(f"r_{name}"), F.coalesce(F.sum(name), F.lit(0)).alias(f"n_{name}"))])
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("pattern"), F.col(f"r_{name}").cast("long").alias("n_rows"), F.col(f"n_{name}").cast("long").alias("n_matches")) for name, _ in PATTERNS]))
    return one.select(rows.alias("x")).select("x.*")


# ---------------------------------------------------------------- JSON

_compiled = [re.compile(p) for _, p in PATTERNS]
_ANY = re.compile("|".join(re.escape(x) for xs in LITERALS.values() for x in xs) + r"|[a-f0-9]{40}")
_ANY_LOW = re.compile("|".join(re.escape(x) for xs in LOWERED.values() for x in xs))
_ESCAPE = "\\"
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]:,]|[^\s{}\[\]:,"]+', re.DOTALL)


def _sensitive(key: str) -> bool:
    key = "".join(c for c in key.lower() if c.isalnum())
    return key in SENSITIVE or HEADER_KEY.fullmatch(key) is not None


def _by_shape(value: str) -> str:
    for p in _compiled:
        value = p.sub(TOKEN, value)
    return value


def json_edits(text: str) -> list[tuple[int, int, str]]:
    """(start, end, new text) of what is to be replaced in a JSON text: strings that hold a secret, and below a sensitive field every scalar but null.
    One walk over the tokens with the path of open objects and arrays; nothing else of the text is touched."""
    edits: list[tuple[int, int, str]] = []
    secret, is_object = [False], [False]  # of each open object or array
    key, field = None, False  # the last key; whether the next string is one
    for m in _TOKEN.finditer(text):
        token = m[0]
        if token in "{[":
            secret.append(secret[-1] or (is_object[-1] and key is not None and _sensitive(key)))
            is_object.append(token == "{")
            field = token == "{"
        elif token in "}]":
            secret.pop()
            is_object.pop()
            field = False
        elif token == ",":
            field = is_object[-1]
        elif token == ":":
            field = False
        elif field:
            key = json.loads(token)
        elif token != "null":
            if secret[-1] or (is_object[-1] and _sensitive(key)):
                edits.append((m.start(), m.end(), f'"{TOKEN}"'))
            elif token[0] == '"':
                value = json.loads(token)
                if (new := _by_shape(value)) != value:
                    edits.append((m.start(), m.end(), json.dumps(new, ensure_ascii=False)))
    return edits


def redact_json_text(text: str | None) -> str | None:
    """One JSON text redacted at any depth; what holds no secret keeps its bytes. Text that is no JSON is redacted as text."""
    if text is None:
        return None
    low = text.lower()
    # a secret in a string may hide behind escapes; a sensitive field is one by the letters of its name
    if _ESCAPE not in text and not _ANY.search(text) and not _ANY_LOW.search(low) and not _KEYS.search(low):
        return text
    try:
        json.loads(text)
    except (ValueError, RecursionError):
        return _by_shape(text)
    out, at = [], 0
    for start, end, new in json_edits(text):
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]])


#: A field's letters and digits with anything else between them; first letters alone would let too much through.
_KEYS = re.compile('"[^"]*(?:' + "|".join(r"[^a-z0-9\"]*".join(k) for k in ["secret", "token", "auth", "pass", "pwd", "credential", "privatekey", "apikey", "accesskeyid"]) + ")")


PIECE = 1 << 20  # bytes of JSON text that are Python strings at a time


def _pieces(b: pa.RecordBatch, k: int):
    """Slices of a batch with about PIECE bytes in column k, or a single longer row."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(b.column(k)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < b.num_rows:
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PIECE, "right")))
        yield b.slice(at, to - at)
        at = to


def redact_json(df: DataFrame, column: str) -> DataFrame:
    """The JSON text column redacted at any depth, in pieces of about a megabyte; text that is no JSON is redacted as text, null stays. Rows without a secret keep their bytes, and of
    the others all bytes but the secrets': numbers, spaces, order and repeated keys are as they were."""

    def run(batches):
        for whole in batches:
            k = whole.schema.get_field_index(column)
            for b in _pieces(whole, k):
                out = [redact_json_text(text) for text in b.column(k).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(out, c.type) if i == k else c for i, c in enumerate(b.columns)], schema=b.schema)

    return df.mapInArrow(run, df.schema)

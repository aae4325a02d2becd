"""Secret scan with structural confirmation.

Patterns find assignments, access keys and long hex runs in whole texts.  On top, base64, base64url and hex
candidates are decoded and reported only if they parse:

* `der`: a DER structure of ASN.1 whose nested lengths fill it exactly, laid out as a private key
  (PKCS#1, PKCS#8 plain or encrypted, SEC1) or a public one; of any algorithm whose identifier is an object
  identifier and whose octet string holds a DER element (a bit string a whole number of bytes; encrypted ones:
  whose parameters are a sequence),
* `ssh`: an OpenSSH private key or a public key blob whose length-prefixed fields fill it exactly,
* `jwt`: a token of three parts whose header is a JSON object with a text "alg".

A candidate over several lines is joined before it is decoded, with markers (as in PEM) or without, and its span
then covers the markers around it, if there are any.  Lines are parted by line breaks with indentation, by
written-out ones (\\n, \\r\\n) and by the quotes of string pieces on lines of their own.  A key begins and ends where
a line does; its own lengths say how many lines it takes.

Defined cases: null text is empty and has no span; spans of different kinds may overlap; repeated rows get a
row each; other columns are ignored.
"""

import base64
import binascii
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from closepass.llm.store import mapped

KINDS = ("assign", "access", "hex", "der", "ssh", "jwt")
BASE = KINDS[:3]

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

INDENT = r"(?:[ \t]|\\+t)*"
QUOTED = r"""["'][ \t]*[+.,]?[ \t]*\\?\r?\n[ \t]*[+.]?[ \t]*["']"""
BREAK = rf"{INDENT}(?:(?:\r\n?|\n|\\+r(?:\\+n)?|\\+n|{QUOTED}){INDENT})+"
BREAKS = re.compile(BREAK)
PEM = re.compile(r"""-----BEGIN ([A-Z0-9 ]+)-----([A-Za-z0-9+/=\s\\"',.]+)-----END \1-----""")
BEFORE = re.compile(rf"-----BEGIN [A-Z0-9 ]+-----(?:{BREAK})?\Z")
AFTER = re.compile(rf"(?:{BREAK})?-----END [A-Z0-9 ]+-----")
MARKER_MOST = 100  # characters of a marker and the break next to it

# a key begins with a DER sequence, three zero bytes or the name of its format
BASE64_START = re.compile(r"(?:(?<![A-Za-z0-9+/_-])|(?<=\\[nrt]))(?=M[IC-H]|AAAA|b3Bl)")
BASE64_LINES = re.compile(rf"[A-Za-z0-9+/_-]+(?:{BREAK}[A-Za-z0-9+/_-]+)*")
BASE64_LEAST = 40
PADDING = re.compile(rf"(?:(?:{BREAK})?=){{0,2}}")
HEX_START = re.compile(r"(?<![0-9A-Fa-f])(?=30|000000|6[Ff]70656[Ee])")
HEX_LINES = re.compile(rf"[0-9A-Fa-f]+(?:{BREAK}[0-9A-Fa-f]+)*")
HEX_LEAST = 48
# a header begins with a brace, or with white space before it
TOKEN = re.compile(
    r"(?<![A-Za-z0-9_-])(?=((?:e[wy]|C[Q-Za-v]|D[Q-Za-f]|I[A-P])[A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*))"
)
DEPTH = 12

#: Object identifiers of key algorithms (RSA, EC, Ed25519, DSA, password-based encryption), which
#: count whatever the key itself looks like.
KEY_ALGORITHMS = tuple(
    bytes.fromhex(x) for x in ("2a864886f70d010101", "2a8648ce3d0201", "2b6570", "2a8648ce380401", "2a864886f70d01050d")
)
#: Key types of SSH.
SSH_TYPES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")
SSH_PRIVATE = b"openssh-key-v1\0"


def decoded(text: str) -> bytes | None:
    """Bytes of base64 or base64url, padded or not."""
    plain = re.sub(r"\s", "", BREAKS.sub("", text)).rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes, depth: int = 0) -> list[tuple[int, object]] | None:
    """(tag, bytes or items) of elements that fill `data` exactly, else None."""
    items: list[tuple[int, object]] = []
    at = 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size = int.from_bytes(data[at : at + n], "big")
            if size < 0x80:
                return None  # DER takes the short form
            at += n
        if at + size > len(data):
            return None
        body: object = data[at : at + size]
        if tag & 0x20:
            if depth >= DEPTH:
                return None
            body = der_items(data[at : at + size], depth + 1)
            if body is None:
                return None
        items.append((tag, body))
        at += size
    return items


def is_der_key(data: bytes) -> bool:
    if len(data) < 24 or data[0] != 0x30:
        return False
    outer = der_items(data)
    if not outer or len(outer) != 1:
        return False
    inner = outer[0][1]
    tags = [t for t, _ in inner]
    algorithm = next((x for t, x in inner[:2] if t == 0x30 and x and x[0][0] == 0x06), None)
    named = algorithm is not None and algorithm[0][1] in KEY_ALGORITHMS
    # other algorithms: by what holds the key
    oid = bool(algorithm) and bool(algorithm[0][1]) and not algorithm[0][1][-1] & 0x80 and len(algorithm) <= 2
    held = inner[tags.index(0x04)][1] if 0x04 in tags[:3] else b""
    bits = inner[1][1] if tags == [0x30, 0x03] else b""
    nested = der_items(held) if held else None
    private = oid and inner[0][1] in (b"\0", b"\1") and bool(nested) and len(nested) == 1 and set(tags[3:]) <= {0xA0, 0xA1, 0x81}
    # a digest with its algorithm has no such parameters
    encrypted = oid and len(algorithm) == 2 and algorithm[1][0] == 0x30 and bool(algorithm[1][1]) and len(held) >= 24
    public = oid and len(bits) > 24 and bits[0] == 0
    numbers = len(inner) >= 2 and all(t == 0x02 for t in tags)
    return (
        (tags[:2] == [0x02, 0x30] and 0x04 in tags[2:3] and (named or private))  # PKCS#8
        or (tags == [0x30, 0x04] and (named or encrypted))  # PKCS#8, encrypted
        or (tags == [0x30, 0x03] and (named or public))  # public key
        or (numbers and len(inner) in (6, 9) and inner[0][1] == b"\0")  # DSA, RSA (PKCS#1)
        or (tags[:2] == [0x02, 0x04] and inner[0][1] == b"\1" and set(tags[2:]) <= {0xA0, 0xA1})  # SEC1
    )


def _fields(data: bytes) -> list[bytes] | None:
    out, at = [], 0
    while at < len(data):
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if at + size > len(data):
            return None
        out.append(data[at : at + size])
        at += size
    return out


def is_ssh_key(data: bytes) -> bool:
    if data.startswith(SSH_PRIVATE):
        rest = data[len(SSH_PRIVATE) :]
        at = 0
        for _ in range(3):  # cipher, key derivation and its options
            if at + 4 > len(rest):
                return False
            at += 4 + int.from_bytes(rest[at : at + 4], "big")
        if at + 4 > len(rest):
            return False
        keys = int.from_bytes(rest[at : at + 4], "big")
        fields = _fields(rest[at + 4 :])
        return bool(fields) and len(fields) == keys + 1 and all(is_ssh_key(k) for k in fields[:-1])
    if data[:3] != b"\0\0\0":
        return False
    fields = _fields(data)
    return bool(fields) and len(fields) >= 2 and fields[0] in SSH_TYPES and all(fields)


def is_signed_token(header: str) -> bool:
    try:
        first = json.loads(decoded(header) or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(first, dict) and isinstance(first.get("alg"), str)


def _key_kind(data: bytes | None) -> str | None:
    if data and data[0] == 0x30 and is_der_key(data):
        return "der"
    if data and (data[0] == 0 or data.startswith(SSH_PRIVATE)) and is_ssh_key(data):
        return "ssh"
    return None


class _Lines:
    """Lines of base64 or hex characters in a text, joined."""

    def __init__(self, text: str, start: int, end: int, is_hex: bool):
        self.is_hex, self.end = is_hex, end
        parts, at, size = [], start, 0
        self.place: dict[int, int] = {}  # start of a line in the text -> in the joined characters
        self.ends: dict[int, int] = {}  # end of a line in the joined characters -> in the text
        for a, b in [*(m.span() for m in BREAKS.finditer(text, start, end)), (end, end)]:
            parts.append(text[at:a])
            self.place[at] = size
            size += a - at
            self.ends[size] = a
            at = b
        self.chars = "".join(parts)

    def bytes(self, at: int, a: int, b: int) -> bytes:
        """Bytes a to b, or fewer at the end, of what is encoded from character `at` on."""
        if self.is_hex:
            own = self.chars[at + 2 * a : at + 2 * b]
            return bytes.fromhex(own[: len(own) // 2 * 2])
        low = a // 3
        own = self.chars[at + 4 * low : at + 4 * -(-b // 3)]
        return (decoded(own[:-1] if len(own) % 4 == 1 else own) or b"")[a - 3 * low : b - 3 * low]

    def until(self, at: int, size: int) -> int | None:
        """The end in the text of `size` bytes from character `at` on, if a line ends there."""
        if self.is_hex:
            end = at + 2 * size
            # of an odd number of digits the last one is left over
            return self.ends[end] if end in self.ends else self.ends[end + 1] - 1 if end + 1 in self.ends else None
        return self.ends.get(at + (4 * size + 2) // 3)

    def sizes(self, at: int) -> list[int]:
        """Sizes in bytes that a key from character `at` on can have, the likeliest first."""
        head = self.bytes(at, 0, len(SSH_PRIVATE))
        left = (len(self.chars) - at) * (4 if self.is_hex else 6) // 8

        def field(begin: int) -> int:
            """The end of a length-prefixed field, beyond `left` if it is cut off."""
            prefix = self.bytes(at, begin, begin + 4)
            return begin + 4 + int.from_bytes(prefix, "big") if len(prefix) == 4 else left + 1

        if head[:1] == b"\x30" and len(head) > 6:
            n = head[1] & 0x7F if head[1] & 0x80 else 0
            return [2 + n + int.from_bytes(head[2 : 2 + n], "big") if n else 2 + head[1]] if n <= 4 else []
        if head == SSH_PRIVATE:
            end = len(SSH_PRIVATE)
            for _ in range(3):
                end = field(end) if end <= left else end
            keys = int.from_bytes(self.bytes(at, end, end + 4), "big") if end <= left else left
            end += 4
            for _ in range(min(keys, left) + 1):
                if end > left:
                    return []
                end = field(end)
            return [end]
        if head[:3] != b"\0\0\0":
            return []
        out, end = [], 0
        while end < left:
            begin, end = end, field(end)
            # another key may begin on the next line
            if end > left or end == begin + 4 or (begin and self.bytes(at, begin + 4, min(end, begin + 24)) in SSH_TYPES):
                break
            out.append(end)
        return out[:0:-1]


def _keys(text: str, is_hex: bool, covered: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """Keys that begin and end with a line, outside `covered`."""
    begins, run, least = (HEX_START, HEX_LINES, HEX_LEAST) if is_hex else (BASE64_START, BASE64_LINES, BASE64_LEAST)
    found, lines, end, done = [], None, 0, 0
    for m in begins.finditer(text):
        start = m.start()
        if start < done or any(a <= start < b for a, b in covered):
            continue
        if start >= end:
            end, lines, first = run.match(text, start).end(), None, start
        if end - start < least:
            continue
        lines = lines or _Lines(text, first, end, is_hex)
        at = lines.place.get(start)
        if at is None or len(lines.chars) - at < least:
            continue
        for size in lines.sizes(at):
            stop = lines.until(at, size)
            if stop is not None and (kind := _key_kind(lines.bytes(at, 0, size))):
                if not is_hex:
                    stop = PADDING.match(text, stop).end() if stop == end else stop
                    before = BEFORE.search(text, max(0, start - MARKER_MOST), start)
                    after = AFTER.match(text, stop)
                    start, stop = before.start() if before else start, after.end() if after else stop
                found.append((start, stop, kind))
                done = stop
                break
    return found


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all secrets of a text, by start and then kind as listed in KINDS."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    covered = []
    if "-----BEGIN " in text:
        for m in PEM.finditer(text):
            kind = _key_kind(decoded(m[2]))
            if kind:
                found.append((m.start(), m.end(), kind))
                covered.append((m.start(), m.end()))
    end = 0
    for m in TOKEN.finditer(text):
        if m.start() >= end and is_signed_token(m[1]):
            end = m.end(3)
            found.append((m.start(), end, "jwt"))
    found += _keys(text, False, covered) + _keys(text, True, [])
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in found)


def _scan(batches):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
    for batch in batches:
        # one text at a time, so that only one of a batch is held twice
        rows = [spans(t.as_py() or "") for t in batch.column("text")]
        out = {"doc_id": batch.column("doc_id")}
        for name in BASE:
            out[f"n_{name}"] = pa.array([sum(k == name for *_, k in r) for r in rows], pa.int64())
        base = (joined([s for s in r if s[2] in BASE]) for r in rows)
        out["base_sha256"] = pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string())
        out["found"] = pa.array([[{"start": a, "end": b, "kind": k} for a, b, k in r] for r in rows], kind)
        out["spans"] = pa.array([joined(r) for r in rows], pa.string())
        yield pa.RecordBatch.from_arrays(list(out.values()), list(out))


def scan(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, found (start, end, kind), spans (as text)."""
    return documents.select("doc_id", "text").transform(
            mapped,
        _scan,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string,"
        " found array<struct<start: long, end: long, kind: string>>, spans string",
    )


def masked(text: str, mark: str = "[SECRET]") -> str:
    """`text` with every stretch of secrets replaced by one mark."""
    out, at = [], 0
    for a, b, _ in spans(text):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join(out) + text[at:]


def without_secrets(documents: DataFrame) -> DataFrame:
    """All documents and columns; secrets in `text` are masked and `n_chars`, if there is one, follows."""
    names = documents.columns

    def run(batches):
        for batch in batches:
            at = names.index("text")
            old = batch.column(at)
            texts = [None if t is None else masked(t) for t in (x.as_py() for x in old)]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, old.type)
            if "n_chars" in names:
                k = names.index("n_chars")
                # a count that says something else than the length of the text is left alone
                counts = [
                    len(new) if new is not None and n == len(was) else n
                    for n, was, new in zip(columns[k].to_pylist(), (x.as_py() or "" for x in old), texts)
                ]
                columns[k] = pa.array(counts, columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return documents.transform(mapped, run, documents.schema)


def op2_structural_secrets(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("found")

"""Canonical forms of web addresses."""

from __future__ import annotations

import re
from functools import lru_cache
from urllib.parse import unquote

# Query parameters that carry tracking only. Names ending in * stand for a prefix.
TRACKING = (
    "utm_*", "fbclid", "gclid", "gclsrc", "dclid", "gbraid", "wbraid", "msclkid", "yclid", "twclid", "ttclid", "igshid", "li_fat_id",
    "mc_cid", "mc_eid", "_ga", "_gl", "_hsenc", "_hsmi", "hsctatracking", "mkt_tok", "ref", "ref_src", "ref_url", "referrer", "source",
    "cmpid", "cmp", "campaign", "campaign_id", "ncid", "cid", "icid", "sr_share", "ocid", "ito", "smid", "partner", "share", "spm",
    "s_cid", "s_kwcid", "ef_id", "vero_id", "vero_conv", "oly_anon_id", "oly_enc_id", "wickedid", "at_medium", "at_campaign", "feature",
)
_NAMES = frozenset(t for t in TRACKING if not t.endswith("*"))
_PREFIXES = tuple(t[:-1] for t in TRACKING if t.endswith("*"))
_PLAIN_ESCAPE = re.compile(r"%(?:2[DEde]|3[0-9]|4[1-9A-Fa-f]|5[0-9Aa]|5[Ff]|6[1-9A-Fa-f]|7[0-9Aa]|7[Ee])")
_ESCAPE = re.compile(r"%[0-9a-fA-F]{2}")


def _unescape(text: str) -> str:
    """Escapes of plain (unreserved) characters resolved, the others in capitals."""
    if "%" not in text:
        return text
    text = _PLAIN_ESCAPE.sub(lambda m: unquote(m[0]), text)
    return _ESCAPE.sub(lambda m: m[0].upper(), text)


def _dots(path: str) -> str:
    if "/." not in path and "//" not in path:
        return path
    out: list[str] = []
    for part in path.split("/"):
        if part == "..":
            if out:
                out.pop()
        elif part not in ("", "."):
            out.append(part)
    return "/" + "/".join(out)


@lru_cache(maxsize=4096)
def _host(netloc: str) -> str:
    host = netloc.rpartition("@")[2].lower()
    name, colon, port = host.rpartition(":")
    if colon and port in ("80", "443", ""):
        host = name
    host = host.rstrip(".")
    return host[4:] if host.startswith("www.") else host


def _is_tracking(name: str) -> bool:
    name = name.lower()
    return name in _NAMES or name.startswith(_PREFIXES)


def canonical_url(url: str | None) -> str:
    """https://host/path?sorted=params, without www, default port, user, tracking parameters, fragment and trailing slash.

    '' for null, empty and blank texts and for texts without a host.
    """
    if not url:
        return ""
    rest = url.strip().partition("#")[0]
    scheme, sep, tail = rest.partition("://")
    if not sep:
        scheme, tail = "https", rest[2:] if rest.startswith("//") else rest
    if scheme.lower() not in ("http", "https"):
        return ""
    tail, _, query = tail.partition("?")
    netloc, _, path = tail.partition("/")
    host = _host(netloc)
    if not host:
        return ""
    path = _dots(_unescape("/" + path)).rstrip("/")
    if query:
        kept = sorted(p for p in (_unescape(q) for q in query.split("&")) if p and not _is_tracking(p.partition("=")[0]))
        if kept:
            return f"https://{host}{path}?{'&'.join(kept)}"
    return f"https://{host}{path}"

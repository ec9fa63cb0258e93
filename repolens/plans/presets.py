"""Run configurations users of the reference pass today, as plain parameters."""

from __future__ import annotations

import re
from datetime import datetime

# Default repository lists (the job's six, the connector's four).
DEFAULT_REPOSITORIES = [
    "cardano-foundation/cardano-wallet",
    "input-output-hk/cardano-node",
    "input-output-hk/plutus",
    "Emurgo/cardano-serialization-lib",
    "input-output-hk/cardano-ledger",
    "input-output-hk/ouroboros-network",
]
CONNECTOR_REPOSITORIES = DEFAULT_REPOSITORIES[:4]

# Repository-selection presets (search text, cap, archived, minimum stars).
PRESETS = {
    "cardano": dict(search="cardano wallet", max_repos=500, include_archived=False, min_stars=0),
    "cardano-popular": dict(search="cardano wallet", max_repos=100, include_archived=False, min_stars=5),
    "cardano-active": dict(search="cardano wallet pushed:>2023-01-01", max_repos=200, include_archived=False,
                           min_stars=0),
    "test": dict(search="cardano wallet", max_repos=10, include_archived=False, min_stars=0),
}

_RANGED = re.compile(r"^(>=|<=|>|<)?(.+)$")
#: Qualifiers that a landed repository can be tested for, with the type of their value.
RANGED_QUALIFIERS = {"pushed": "timestamp_ntz", "created": "timestamp_ntz", "stars": "double", "forks": "double"}


def _range(name: str, text: str) -> dict:
    """``>a``, ``>=a``, ``<b``, ``<=b``, ``a..b`` (either side ``*`` for open) or the value itself."""
    if ".." in text:
        low, _, high = text.partition("..")
        out = {"low": None if low == "*" else low, "high": None if high == "*" else high}
    else:
        op, value = _RANGED.match(text).groups()
        out = {"low": value if op in (None, ">", ">=") else None, "high": value if op in (None, "<", "<=") else None,
               "low_open": op == ">", "high_open": op == "<"}
    for side in ("low", "high"):
        if out[side] is not None:
            try:
                out[side] = float(out[side]) if RANGED_QUALIFIERS[name] == "double" else datetime.fromisoformat(out[side]).isoformat()
            except ValueError:
                raise ValueError(f"{name}:{text} is not a range of {RANGED_QUALIFIERS[name]}") from None
    return out


def split_qualifiers(search: str | None) -> tuple[str, dict]:
    """Split ``name:value`` search qualifiers from free-text terms.

    ``pushed:``, ``created:``, ``stars:`` and ``forks:`` take a value, ``>``, ``>=``, ``<``, ``<=`` or a
    range ``a..b`` and give ``{name: {low, high, low_open, high_open}}`` (several of a name all hold);
    ``archived:true|false`` and ``language:x`` give their value. Any other qualifier raises: it could not
    be honoured. Text without a colon stays a term.
    """
    terms, opts = [], {}
    for tok in (search or "").split():
        name, colon, value = tok.partition(":")
        if not colon:
            terms.append(tok)
        elif name in RANGED_QUALIFIERS and value:
            opts.setdefault(name, []).append(_range(name, value))
        elif name == "archived" and value.lower() in ("true", "false"):
            opts["archived"] = value.lower() == "true"
        elif name == "language" and value:
            opts["language"] = value
        else:
            raise ValueError(f"unsupported search qualifier {tok!r}")
    return " ".join(terms), opts

"""Column-name rules."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable


def snake_case(name: str) -> str:
    """camelCase/PascalCase -> snake_case with the ingest rule of the original flow.

    Fixed behaviour (observable in table schemas, so kept exactly): an underscore goes
    before every ASCII capital letter A-Z except the first character of the name, and
    the whole result is lower-cased. Acronyms therefore split letter by letter
    (``HTTPServer`` -> ``h_t_t_p_server``), existing underscores are not merged
    (``Already_Snake`` -> ``already__snake``), non-ASCII capitals are lower-cased but
    do not start a new word, and spaces stay.
    """
    out = []
    for i, ch in enumerate(name):
        if i > 0 and "A" <= ch <= "Z":
            out.append("_")
        out.append(ch)
    return "".join(out).lower()


def snake_case_all(names: Iterable[str], case_sensitive: bool = False) -> list[str]:
    """Rename every name; raise ``ValueError`` naming any result used twice."""
    new = [snake_case(n) for n in names]
    keyed = new if case_sensitive else [n.lower() for n in new]
    clashes = sorted(k for k, c in Counter(keyed).items() if c > 1)
    if clashes:
        raise ValueError(f"column names clash after snake_case rename: {clashes}")
    return new

"""Fragments shared by the checking SQL."""

from __future__ import annotations


def half_up(x: str, digits: int = 0) -> str:
    return f"(sign({x}) * floor(abs({x}) * 1e{digits} + 0.5) / 1e{digits})"


def total(x: str) -> str:
    """Order-free sum; the given amounts have at most six decimals."""
    return f"CAST(sum(CAST({x} AS DECIMAL(18,6))) AS DOUBLE)"


def mean(x: str) -> str:
    return f"({total(x)} / count({x}))"


def mean_round(x: str, digits: int = 2) -> str:
    return half_up(mean(x), digits)


WORD = r"\p{L}\p{N}_"
SPACE = (
    r" \t-\r\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)


def clean_social(x: str) -> str:
    return (
        f"regexp_replace(regexp_replace(regexp_replace(lower({x}), '@[{WORD}]+', '', 'g'),"
        f" 'http[^{SPACE}]+', '', 'g'), '[^{WORD}{SPACE}]+', '', 'g')"
    )


def clean_review(x: str) -> str:
    for pattern in (
        f"(http|www)[^{SPACE}]+",
        f"@[{WORD}]+",
        "#",
        r"\p{Nd}+",
        f"[^{WORD}{SPACE}]+",
    ):
        x = f"regexp_replace({x}, '{pattern}', '', 'g')"
    return f"lower({x})"


def quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)

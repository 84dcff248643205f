"""Small pieces of SQL shared by the check queries (for DuckDB)."""

WS = r"\p{Z}\x09-\x0d\x1c-\x1f\x{85}"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def draw(seed: str, row_id: str, epoch: str = "0") -> str:
    return f"(cast('0x' || substr(md5(concat_ws('|', '{seed}', '{epoch}', cast({row_id} as varchar))), 1, 8) as bigint) / 4294967296.0::double)"


def pick(seed: str, row_id: str, n: int, epoch: str = "0") -> str:
    return f"(cast('0x' || substr(md5(concat_ws('|', '{seed}', '{epoch}', cast({row_id} as varchar))), 1, 8) as bigint) % {n})"


def order_key(seed: int, epoch: int, row_id: str) -> str:
    return f"md5(concat_ws('|', '{seed}', '{epoch}', cast({row_id} as varchar)))"


def words(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{WS}]')"


def penalty(x: str) -> str:
    """Share of repeated 3-grams times 1.0, at most 0.5."""
    grams = f"list_transform(range(1, len(w) - 1), lambda i: w[i] || chr(1) || w[i+1] || chr(1) || w[i+2])"
    return (
        f"(select case when len(g) > 0 then least(0.5::double, (len(g) - len(list_distinct(g))) * 1.0::double / len(g)) else 0.0::double end"
        f" from (select {grams} as g from (select {words(x)} as w)))"
    )


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"

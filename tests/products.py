"""Product histories for the tests."""

HEADER = "product_id string, updated_at string, source_sequence string, name string, category string, price string, is_active string"


def fragment(spark, rows):
    """Text rows as a CSV fragment holds them; a time alone is taken to be on 2026-01-01."""
    cells = [
        tuple(f"2026-01-01T{v}:00Z" if i == 1 and len(v) == 5 else str(v) for i, v in enumerate(row)) for row in rows
    ]
    return spark.createDataFrame(cells, HEADER)


def counters(result):
    run = result.run
    return (
        run.rows_received,
        run.rows_after_deduplication,
        run.rows_inserted,
        run.rows_updated,
        run.rows_ignored,
    )

import json

from clinflow.sources import read_ndjson


def write_lines(folder, resource, records, shard=0):
    """One NDJSON shard; a record given as text is written as it is."""
    folder.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    (folder / f"{resource}_{shard:03d}.ndjson").write_text("\n".join(lines) + "\n")


def read(spark, folder, resource, records):
    write_lines(folder, resource, records)
    return read_ndjson(spark, str(folder), resource)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df):
    """Physical plan as text."""
    import contextlib
    import io
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def same_in_one_block_and_many(spark, build):
    """Whether a plan gives the same rows with one partition and with many uncoalesced ones."""
    settings = {"spark.sql.shuffle.partitions": ("1", "13"),
                "spark.sql.adaptive.coalescePartitions.enabled": ("true", "false")}
    before = {k: spark.conf.get(k) for k in settings}
    found = []
    try:
        for i in (0, 1):
            for k, values in settings.items():
                spark.conf.set(k, values[i])
            found.append(rows(build()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return found[0] == found[1] and bool(found[0])

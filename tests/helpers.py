import datetime as dt

SAMPLE_SCHEMA = (
    "metric string, series_id long, user_id long, ts timestamp_ntz, value double, node string, labels string, payload string"
)


def sample_rows(spec):
    """spec: list of (metric, node, day, hour, n_rows, payload) -> sample tuples."""
    out = []
    sid = 0
    for metric, node, day, hour, n, payload in spec:
        for i in range(n):
            sid += 1
            ts = dt.datetime(2024, 1, day, hour, 0, i % 60, i)
            labels = '{"__name__":"%s","user":"%d"}' % (metric, i)
            out.append((metric, 1000 + i, i, ts, float(i), node, labels, payload))
    return out


def samples_df(spark, spec):
    return spark.createDataFrame(sample_rows(spec), SAMPLE_SCHEMA)

"""What the tests of the library share."""

SF_DIR = "/root/testdata/sf0.001"


def fact(element, context="CurrentYearDuration", value="1", **more):
    row = {
        "element": element, "label": element, "context": context, "rel_year": "当期",
        "consol": "連結", "period_type": "期間", "unit": "円", "value": value,
    }
    return {**row, **more}


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())

from kessan.functions import dates, filters, numbers, text  # noqa: F401

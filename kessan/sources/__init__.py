"""Readers. Each returns a DataFrame with a declared schema."""

from kessan.sources.companies import (  # noqa: F401
    read_company_list,
    read_company_master,
    read_exchange_listing,
    read_filings_list,
    read_target_list,
    read_ticker_list,
)
from kessan.sources.facts import (  # noqa: F401
    land_facts,
    read_fact_files,
    read_facts,
    read_header_columns,
    scan_fact_files,
    split_scan,
)
from kessan.sources.filings import (  # noqa: F401
    list_corpus,
    read_filing_metadata,
    read_index_responses,
    read_judgements,
)
from kessan.sources.lake import (  # noqa: F401
    land_batch,
    land_by_filing,
    read_by_filing,
    read_headers,
    read_manifest,
)
from kessan.sources.tables import (  # noqa: F401
    list_tables,
    read_statement_rows,
    read_template,
    read_wide_export,
    template_items,
)

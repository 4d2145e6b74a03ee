"""docrank: ranked document retrieval on Spark DataFrames."""

from docrank.operators.compare import compare, compare_batch, compare_results
from docrank.operators.fulltext import (WeightedIndex, build_fulltext, fulltext_lexemes, fulltext_search,
                                        fulltext_search_batch, read_fulltext, stored_lexemes, write_fulltext)
from docrank.operators.index import (Index, IndexOptions, build_index, drop_old_versions, normalized_postings,
                                     posting_lists, read_index, write_index)
from docrank.operators.merge import merge_counts, merge_index
from docrank.operators.search import hydrate, result_rows, search, search_batch
from docrank.sources.papers import get_paper, get_papers, list_papers, read_papers, read_table, to_json_rows

__all__ = [
    "Index", "IndexOptions", "build_index", "write_index", "read_index", "drop_old_versions", "normalized_postings", "posting_lists",
    "search", "search_batch", "hydrate", "result_rows",
    "WeightedIndex", "write_fulltext", "read_fulltext", "stored_lexemes", "compare_results",
    "fulltext_lexemes", "build_fulltext", "fulltext_search", "fulltext_search_batch",
    "compare", "compare_batch", "merge_counts", "merge_index",
    "read_papers", "read_table", "list_papers", "get_paper", "get_papers", "to_json_rows",
]

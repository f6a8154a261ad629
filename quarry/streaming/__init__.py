"""Streaming forms. The reference has no stream, watermark or state of its own;
the forms here are the one-pass term count applied to article-line files
arriving in a folder (Structured Streaming), the same operator as the batch
`terms.rank_one_pass`, and the seed sample of points that keep arriving, the same
as the batch `sampling.sample_per_tag`."""

from quarry.streaming.samples import sample_stream
from quarry.streaming.terms import term_counts_stream

__all__ = ["sample_stream", "term_counts_stream"]

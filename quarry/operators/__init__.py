"""DataFrame -> DataFrame operators: `terms` (ranking, inverted index),
`postings` (validity, question/answer join, scores, vectors), `sampling`
(seed selection), `clustering` (k-means and cluster statistics) and `timeuse`
(column classes, recodes, grouped means)."""

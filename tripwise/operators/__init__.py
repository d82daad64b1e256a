"""DataFrame operators: cleaning, joins, outliers, clustering, models, scoring."""

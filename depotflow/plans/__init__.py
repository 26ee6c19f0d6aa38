"""Jobs: data quality, cleaning, dimensions, KPI marts, measures and worksheets."""

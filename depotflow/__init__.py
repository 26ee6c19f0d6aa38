"""depotflow: batch distribution analytics (sales, production, stock, receivables) on Spark."""

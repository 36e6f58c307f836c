"""Calendar, dimensions, facts, reload, quality report and KPIs."""

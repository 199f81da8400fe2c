"""The warehouse itself: entities, star fact, KPI views and reports."""

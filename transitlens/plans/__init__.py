"""Composed plans: the speed flow, warehouse build, reports and the query catalogue."""

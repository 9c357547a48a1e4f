"""Compositions: report layouts, channel jobs, the warehouse build and the registered queries."""

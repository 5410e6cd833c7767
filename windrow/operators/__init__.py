"""DataFrame-to-DataFrame operators: windows, totals, reduces, lateness, stagger, publishing."""

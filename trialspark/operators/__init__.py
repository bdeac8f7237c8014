"""DataFrame operators, one module per analytic area."""

"""DataFrame-to-DataFrame operators. All are lazy unless a docstring says otherwise."""

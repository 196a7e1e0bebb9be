"""DataFrame operators; each works on static and streaming frames unless it says otherwise."""

"""Stream management, streaming rules and the streaming alert writer."""

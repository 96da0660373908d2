"""Jobs over growing inputs."""
